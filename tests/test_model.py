import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.catalog.facts import elbow_facts, fit_facts, rank_facts
from flowlens.operators.boundaries import cluster_boundaries
from flowlens.functions.nearest import closest
from flowlens.operators.clustering import (
    assign, centers_from_table, centers_table, clustering_cost, elbow_curve, first_centers,
    fit_clusters, load_ml_centers, pinned_sweep, refine_centers,
)
from flowlens.operators.scaling import Scaler, fit_scaler, standardize
from flowlens.operators.sweep import parallel_starts, scan, shared_sweep
from flowlens.schemas import FEATURES, KEYS


def feature_rows(spark, values):
    """One row per value; ``n_events`` is the value, ``n_src_port`` its square, the rest 1."""
    rows = [(f"s{i:04d}", "d", None, "00:00:00", "Mon", v, v * v, *[1] * 18)
            for i, v in enumerate(values)]
    schema = ", ".join(
        [f"{c} {'date' if c == 'day' else 'string'}" for c in KEYS]
        + [f"{c} bigint" for c in FEATURES])
    return spark.createDataFrame(rows, schema)


def vectors(spark, points):
    return spark.createDataFrame([(list(map(float, p)),) for p in points],
                                 "normalizedFeatures array<double>")


def test_scaler_and_zero_deviation(spark):
    scaler = fit_scaler(feature_rows(spark, [1, 2, 3, 6]))
    assert scaler.mean[0] == 3.0
    assert scaler.std[0] == pytest.approx(np.std([1, 2, 3, 6], ddof=1))
    assert scaler.std[2:] == (0.0,) * 18
    z = [r.normalizedFeatures for r in
         standardize(feature_rows(spark, [1, 6]), scaler).orderBy("src_ip").collect()]
    assert z[0][0] == pytest.approx(-2 / scaler.std[0])
    assert z[1][2:] == [0.0] * 18


def test_standardize_with_extreme_numbers(spark):
    scaler = Scaler((-1.5e-7, 2.5e21, *[0.0] * 18), (1e-9, 3e20, *[0.0] * 18))
    z = standardize(feature_rows(spark, [2]), scaler).first().normalizedFeatures
    assert z[:2] == [(2 + 1.5e-7) / 1e-9, (4 - 2.5e21) / 3e20]


def test_scaler_of_one_row_and_none(spark):
    assert fit_scaler(feature_rows(spark, [4])).std == (0.0,) * 20
    with pytest.raises(ValueError):
        fit_scaler(feature_rows(spark, [4]).limit(0))


def test_scaler_equals_spark_ml(spark):
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector
    table = feature_rows(spark, [1, 5, 9, 2, 2, 40])
    scaler = fit_scaler(table)
    ready = standardize(table, scaler).select(array_to_vector("features").alias("v"))
    model = StandardScaler(inputCol="v", outputCol="z", withMean=True, withStd=True).fit(ready)
    assert list(model.mean) == pytest.approx(scaler.mean)
    assert list(model.std) == pytest.approx(scaler.std)


def test_assign_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    points, centers = rng.normal(size=(500, 6)), rng.normal(size=(9, 6))
    found = assign(vectors(spark, points), centers.tolist()).collect()
    for row in found:
        d = np.linalg.norm(centers - np.array(row.normalizedFeatures), axis=1)
        assert row.prediction == d.argmin() and row.distance == pytest.approx(d.min())


def test_assign_tie_goes_to_lowest_id(spark):
    row = assign(vectors(spark, [[0, 0]]), [[3.0, 0.0], [0.0, 1.0], [1.0, 0.0]]).first()
    assert (row.prediction, row.distance) == (1, 1.0)


def test_assign_runs_once_under_filters(spark):
    table = assign(vectors(spark, [[0, 0], [5, 5]]), [[0.0, 0.0]])
    plan = table.where("distance > 1 AND prediction = 0")._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_assign_empty_table(spark):
    assert assign(vectors(spark, [[1, 1]]).limit(0), [[0.0, 0.0]]).count() == 0


def test_refine_keeps_empty_centre(spark):
    centers = refine_centers(vectors(spark, [[0, 0], [2, 0]]), [[0.0, 0.0], [90.0, 0.0]], 2)
    assert centers == [[1.0, 0.0], [90.0, 0.0]]


def test_refine_reaches_the_fit(spark):
    points = [[x, y] for x in (0, 10) for y in (0, 1, 2)]
    table = vectors(spark, points)
    fit = fit_clusters(table, 2)
    ours = refine_centers(table, [[0.0, 0.0], [10.0, 0.0]], 3)
    assert np.allclose(sorted(fit.centers), sorted(ours))
    assert fit.cost == pytest.approx(clustering_cost(assign(table, fit.centers)).first().cost)


def test_fit_with_few_distinct_points(spark):
    fit = fit_clusters(vectors(spark, [[0, 0], [0, 0], [1, 1], [5, 5]]), 5)
    assert len(fit.centers) <= 3 and fit.cost == pytest.approx(0)


def test_first_centers_follow_keys(spark):
    table = feature_rows(spark, [7, 8, 9])
    ready = standardize(table, Scaler((0.0,) * 20, (1.0,) * 20)).orderBy(F.desc("src_ip"))
    assert [c[0] for c in first_centers(ready, 2)] == [7.0, 8.0]


def test_centers_roundtrip(spark):
    centers = [[1.0, 2.0], [3.0, 4.0]]
    assert centers_from_table(centers_table(spark, centers)) == centers
    with pytest.raises(ValueError):
        centers_from_table(centers_table(spark, centers).where("prediction = 1"))


def test_ml_model_roundtrip(spark, tmp_path):
    fit = fit_clusters(vectors(spark, [[0, 0], [9, 9]]), 2)
    path = str(tmp_path / "model")
    fit.model.write().save(path)
    assert load_ml_centers(path) == fit.centers


def test_elbow_falls_and_covers_the_range(spark):
    table = vectors(spark, [[i % 4 * 10 + i / 100, 0] for i in range(80)])
    points = elbow_curve(table, range(2, 5), "normalizedFeatures").orderBy("k").collect()
    assert [p.k for p in points] == [2, 3, 4]
    assert points[0].cost > points[1].cost > points[2].cost


def scored(spark, groups):
    rows = [(p, float(d)) for p, ds in groups.items() for d in ds]
    return spark.createDataFrame(rows, "prediction int, distance double").repartition(7)


GROUPS = {
    0: np.random.default_rng(1).lognormal(size=3000),
    1: [4.0] * 900 + [1.0] * 50 + [9.0] * 50,
    3: [2.5],
    4: np.concatenate([np.zeros(700), np.random.default_rng(2).normal(50, 9, 800)]),
    6: [0.0, 1e-300, 1.0, 1e300],
}


@pytest.mark.parametrize("percentile", [1, 5, 50, 92, 99])
@pytest.mark.parametrize("bins", [200, 8, 2])
def test_exact_boundaries(spark, percentile, bins):
    table = cluster_boundaries(scored(spark, GROUPS), percentile, bins=bins)
    found = {r.prediction: r.boundary for r in table.collect()}
    assert found.keys() == GROUPS.keys()
    for p, values in GROUPS.items():
        assert found[p] == pytest.approx(np.percentile(values, percentile), rel=1e-12), p


def test_approx_boundaries(spark):
    table = cluster_boundaries(scored(spark, GROUPS), 92, "approx", accuracy=100_000)
    for r in table.collect():
        values = np.sort(GROUPS[r.prediction])
        assert r.boundary == values[math.ceil(len(values) * 0.92) - 1]


@pytest.mark.parametrize("percentile", [0, 100])
def test_percentile_limits(spark, percentile):
    with pytest.raises(ValueError):
        cluster_boundaries(scored(spark, {0: [1.0]}), percentile)


def test_null_distances_do_not_count(spark):
    table = spark.createDataFrame([(0, 1.0), (0, None), (0, 3.0), (1, None)],
                                  "prediction int, distance double")
    for method in ("exact", "approx"):
        assert {r.prediction for r in cluster_boundaries(table, 50, method).collect()} == {0}
    assert cluster_boundaries(table, 50).first().boundary == 2.0
    assert cluster_boundaries(table.limit(0), 50).collect() == []


def test_too_many_clusters(spark, monkeypatch):
    monkeypatch.setattr("flowlens.operators.boundaries.MAX_CLUSTERS", 3)
    with pytest.raises(ValueError, match="clusters"):
        cluster_boundaries(scored(spark, {i: [1.0] for i in range(5)}), 50)


def test_nan_has_no_cluster(spark):
    row = assign(vectors(spark, [[math.nan, 0]]), [[0.0, 0.0]]).first()
    assert (row.prediction, row.distance) == (None, None)


def facts_of(spark, points, centers, model, cost):
    from pyspark.ml.functions import array_to_vector
    table = assign(vectors(spark, points), centers).withColumn(
        "vector", array_to_vector("normalizedFeatures"))
    scored_rows = model.setFeaturesCol("vector").setPredictionCol("other").transform(table)
    return fit_facts(scored_rows, len(centers), cost).first()


def test_a_wrong_centre_is_seen(spark):
    points = [[x + i / 10, y] for x in (-6, 6) for y in (-2, 2) for i in (-1, 0, 1)]
    fit = fit_clusters(vectors(spark, points), 4)
    good = facts_of(spark, points, fit.centers, fit.model, fit.cost)
    assert good.all_nearest and good.cost_below_total and good.cost_at_most_training
    assert (good.k, good.n_rows) == (4, 12)
    wrong = [[c[0] * 20, c[1]] if i == 0 else c for i, c in enumerate(fit.centers)]
    bad = facts_of(spark, points, wrong, fit.model, fit.cost)
    assert not bad.all_nearest and not bad.cost_at_most_training
    far = facts_of(spark, points, [[90.0, 90.0]] * 4, fit.model, fit.cost)
    assert not far.cost_below_total


def test_a_wrong_boundary_is_seen(spark):
    table = scored(spark, GROUPS)
    found = cluster_boundaries(table, 92)
    flagged = table.join(found, "prediction")
    row = rank_facts(flagged, 92).first()
    assert (row.k, row.n_rows, row.ranks_hold) == (5, sum(map(len, GROUPS.values())), True)
    assert not rank_facts(flagged.withColumn("boundary", F.col("boundary") * 1.05), 92).first().ranks_hold
    assert not rank_facts(flagged, 80).first().ranks_hold


def test_elbow_facts(spark):
    table = vectors(spark, [[0, 0], [0, 4], [3, 0]])
    clusters = spark.createDataFrame(
        [(2, 0, 2, 4.5, [1.5, 0.0]), (2, 1, 1, 0.0, [0.0, 4.0]), (3, 0, 3, 0.0, [90.0, 0.0])],
        "k int, prediction int, n_rows bigint, cost double, center array<double>")
    rows = elbow_facts(clusters, table, "normalizedFeatures").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(2, 3, True, True), (3, 3, False, False)]


def random_points(n=700, width=5, seed=3):
    random = np.random.default_rng(seed)
    spots = random.normal(0, 50, (9, width))
    return np.round(spots[random.integers(0, 9, n)] + random.normal(0, 2, (n, width)), 2)


def keyed(table):
    """With a key in the order of the vectors' hashes, so that first rows are defined."""
    return table.withColumn("src_ip", F.hex(F.xxhash64("normalizedFeatures")))


def test_closest_equals_brute_force():
    """Also where the matrix product cannot tell: ties, equal centres, huge and tiny numbers."""
    random = np.random.default_rng(0)
    for scale in (1.0, 1e-9, 1e9):
        points = np.round(random.normal(0, 3, (400, 4))) * scale
        centers = np.round(random.normal(0, 3, (30, 4))) * scale
        centers[7] = centers[3]
        points[5] = (centers[1] + centers[2]) / 2
        label, squared = closest(points + 1e6 * scale, centers + 1e6 * scale)
        moved = points + 1e6 * scale, centers + 1e6 * scale
        exact = np.stack([np.einsum("ij,ij->i", moved[0] - c, moved[0] - c) for c in moved[1]], 1)
        assert (label == exact.argmin(axis=1)).all() and (squared == exact.min(axis=1)).all()


def test_shared_scan_equals_one_by_one(spark):
    """The shared scan against assign-and-average of each count on its own."""
    table = keyed(vectors(spark, random_points().tolist())).repartition(5)
    ks, steps = [2, 3, 7, 12], 4
    sweep = pinned_sweep(table, ks, steps)
    assert sweep.scans == steps + 1
    start = first_centers(table, max(ks))
    for k in ks:
        centers = refine_centers(table, start[:k], steps)
        assert np.allclose(sweep.centers[k], centers, atol=1e-9)
        rows = assign(table, centers).groupBy("prediction").agg(
            F.count("distance").alias("n"), F.sum(F.col("distance") ** 2).alias("cost")).collect()
        assert {r.prediction: r.n for r in rows} == {
            i: n for i, n in enumerate(sweep.moments[k].n.tolist()) if n}
        assert sum(r.cost for r in rows) == pytest.approx(sweep.moments[k].cost.sum(), abs=1e-6)


def test_sweep_finds_what_single_fits_find(spark):
    """Nine spots: both fall steeply up to nine, and cost about the same there."""
    table = vectors(spark, random_points().tolist()).repartition(3)
    shared = {r.k: r.cost for r in elbow_curve(table, range(2, 13), "normalizedFeatures").collect()}
    each = {r.k: r.cost for r in elbow_curve(table, [2, 9, 12], "normalizedFeatures",
                                             method="each").collect()}
    assert shared[12] <= shared[9] < shared[5] / 3 < shared[2] / 3
    assert shared[9] <= each[9] * 1.3 and shared[12] <= each[12] * 1.3
    with pytest.raises(ValueError):
        elbow_curve(table, [2], method="some")


def test_sweep_stops_counts_that_rest_and_never_costs_more(spark):
    table = keyed(vectors(spark, random_points(200).tolist()))
    start = {k: np.array(first_centers(table, 12)[:k]) for k in (3, 12)}
    before = scan(table, start, "normalizedFeatures")
    sweep = shared_sweep(table, start, 50, "normalizedFeatures")
    assert sweep.scans < 51
    for k in start:
        assert sweep.moments[k].cost.sum() <= before[k].cost.sum()
        again = shared_sweep(table, {k: sweep.centers[k]}, 1, "normalizedFeatures", None)
        assert np.allclose(again.centers[k], sweep.centers[k], atol=1e-4)


def test_sweep_of_few_or_odd_rows(spark):
    table = vectors(spark, [[1, 1], [1, 1], [5, 5], [float("nan"), 2]])
    points = elbow_curve(table, [2, 6], "normalizedFeatures").orderBy("k").collect()
    assert [(p.k, p.cost) for p in points] == [(2, 0.0), (6, 0.0)]
    starts = parallel_starts(table, [6], "normalizedFeatures")
    assert sorted(map(tuple, starts[6])) == [(1, 1), (5, 5)]
    with pytest.raises(ValueError):
        elbow_curve(table.limit(0), [2], "normalizedFeatures")
