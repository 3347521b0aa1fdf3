"""Rollups, boundaries and scalers from stored sketches and moments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.catalog.flows import flows
from flowlens.operators.boundaries import cluster_boundaries
from flowlens.operators.boundary_sketches import (
    append_sketches, distance_sketches, rank_error, read_sketches, refreshed, united,
)
from flowlens.operators.connections import SKETCHES, connection_features
from flowlens.operators.detector import Detector
from flowlens.operators.moments import append_moments, read_moments, scaler_of_moments
from flowlens.operators.rollups import relative_error, rollup, within
from flowlens.operators.scaling import fit_scaler
from flowlens.schemas import FEATURES, KEYS
from test_detector import PLAIN
from test_model import feature_rows


def rows(table):
    return sorted(map(tuple, table.collect()), key=repr)


def busy_events(spark, n=40_000):
    """One pair with most events and very many ports, over two days."""
    return spark.range(n).select(
        F.when(F.col("id") % 10 < 7, "busy").otherwise(F.concat(F.lit("s"), F.col("id") % 9))
        .alias("src_ip"), F.lit("d").alias("dst_ip"),
        F.date_format(F.timestamp_seconds(1_704_100_000 + F.col("id") * 3), "yyyy-MM-dd HH:mm:ss")
        .alias("end_time"), (F.col("id") * 7919 % 50_000).alias("src_port"),
        (F.col("id") % 3).alias("dst_port"), F.lit("TCP").alias("protocol_name"))


def test_sketches_leave_the_features_alone(spark, sf_dir):
    events = flows(spark, sf_dir)
    for options in ({}, {"segment": "10:00:00"}, {"bucket_seconds": 3600}):
        plain = connection_features(events, **options)
        sketched = connection_features(events, **options, lg_k=12)
        assert sketched.columns == [*KEYS, *FEATURES, *SKETCHES]
        assert rows(sketched.drop(*SKETCHES)) == rows(plain)


@pytest.mark.parametrize("lg_k", [10, 12])
def test_rollup_of_many_ports(spark, lg_k):
    events = busy_events(spark)
    stored = connection_features(events, 300, lg_k=lg_k)
    by_hour = rollup(stored, 3600)
    for bucket, table in ((3600, by_hour), (86400, rollup(by_hour, 86400))):
        exact = {tuple(r[:5]): r for r in connection_features(events, bucket).collect()}
        found = table.collect()
        assert len(found) == len(exact)
        for r in found:
            own = exact[tuple(r[:5])]
            assert [r[c] for c in FEATURES if c != "n_src_port"] == [
                own[c] for c in FEATURES if c != "n_src_port"]
            error = abs(r.n_src_port - own.n_src_port) / own.n_src_port
            assert error <= 4 * relative_error(lg_k)
    whole = rollup(by_hour, None, ["dst_ip"]).first()
    assert whole.n_events == 40_000 and whole.n_dst_port == 3
    assert abs(whole.n_src_port - 40_000) <= 4 * relative_error(lg_k) * 40_000
    assert 0 < abs(whole.n_src_port - 40_000)


def test_rollup_of_nothing_and_of_rows_without_a_day(spark):
    events = busy_events(spark, 50)
    assert rollup(connection_features(events.limit(0), lg_k=8)).collect() == []
    untimed = connection_features(events.withColumn("end_time", F.lit("soon")), lg_k=8)
    found = rollup(untimed).collect()
    assert {r.day for r in found} == {None} and sum(r.n_events for r in found) == 50
    with pytest.raises(ValueError):
        rollup(untimed, 7 * 60)


def test_within(spark):
    table = spark.createDataFrame([(3, 3), (4, 3), (1049, 1000), (1050, 1000)], "e long, n long")
    found = table.select(within(F.col("e"), F.col("n"), 12).alias("w")).collect()
    assert [r.w for r in found] == [True, False, False, False]
    assert [r.w for r in table.select(within(F.col("e"), F.col("n"), 12, 3.1).alias("w")).collect()] \
        == [True, False, True, True]


def scored(spark, n=60_000):
    """A cluster with most rows, one with one value, over three days."""
    return spark.range(n).select(
        F.when(F.col("id") % 50 == 0, 1).when(F.col("id") % 50 == 1, 2).otherwise(0).alias("prediction"),
        F.when(F.col("id") % 50 == 1, 4.0).otherwise(F.exp(F.randn(3))).alias("distance"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 3).cast("int")).alias("day"))


@pytest.mark.parametrize("k", [256, 4096])
def test_united_boundary_has_the_rank(spark, k):
    table = scored(spark).cache()
    parts = [distance_sketches(table.where(F.col("distance") % 1 < 0.5), k),
             distance_sketches(table.where(F.col("distance") % 1 >= 0.5), k)]
    found = {r.prediction: r for r in united(parts[0].unionByName(parts[1]), 92).collect()}
    exact = {r.prediction: r.boundary for r in cluster_boundaries(table, 92).collect()}
    for i, values in ((p, np.sort([r.distance for r in table.where(F.col("prediction") == p)
                                  .select("distance").collect()])) for p in range(3)):
        r = found[i]
        assert r.n_rows == len(values)
        low, high = (np.searchsorted(values, r.boundary, side) / len(values)
                     for side in ("left", "right"))
        slack = rank_error(k) + 1 / len(values)
        assert low - slack <= 0.92 <= high + slack
    assert found[2].boundary == exact[2] == 4.0


def test_refresh_from_stored_loads(spark, tmp_path):
    path = str(tmp_path / "sketches")
    detector = Detector(PLAIN, [[0.0] * 20, [100.0] + [0.0] * 19], {0: 1.0, 1: 7.0})
    table = feature_rows(spark, list(range(40))).withColumn("day", F.lit("2024-01-02").cast("date"))
    late = table.withColumn("day", F.lit("2024-01-09").cast("date"))
    for load, part in (("a", table), ("b", late), ("b", late)):
        append_sketches(part, detector, path, load)
    days = read_sketches(spark, path, detector, "2024-01-01", "2024-01-03")
    new = refreshed(days, detector, 50)
    own = cluster_boundaries(detector.score(table), 50, "approx").first()
    assert new.boundaries == {0: own.boundary, 1: 7.0}
    assert new.model_id() == detector.model_id()
    both = united(read_sketches(spark, path, detector), 50)
    assert [r.n_rows for r in both.collect()] == [80]
    other = Detector(PLAIN, [[1.0] * 20], {0: 3.0})
    assert read_sketches(spark, path, other).count() == 0
    assert refreshed(read_sketches(spark, path, other), other, 50) == other


def test_scaler_of_moments(spark, tmp_path, sf_dir):
    path = str(tmp_path / "moments")
    table = connection_features(flows(spark, sf_dir), 86400).withColumn(
        "n_octetos", F.col("n_octetos") + 10 ** 12)
    for i in range(3):
        append_moments(table.where(F.pmod(F.xxhash64("src_ip"), F.lit(3)) == i), path, f"l{i}")
    append_moments(table.where(F.pmod(F.xxhash64("src_ip"), F.lit(3)) == 1), path, "l1")
    for first, last in ((None, None), ("2024-01-05", "2024-01-09")):
        found = scaler_of_moments(read_moments(spark, path, first, last))
        chosen = table if first is None else table.where(F.col("day").between(first, last))
        whole = fit_scaler(chosen)
        assert found.mean == pytest.approx(whole.mean, rel=1e-12)
        assert found.std == pytest.approx(whole.std, rel=1e-7)
    with pytest.raises(ValueError):
        scaler_of_moments(read_moments(spark, path, "1999-01-01", "1999-01-02"))
    one = str(tmp_path / "one")
    append_moments(table.limit(1), one)
    assert set(scaler_of_moments(read_moments(spark, one)).std) == {0.0}
