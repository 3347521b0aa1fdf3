"""Registered queries: one per operator, over the whole given tables."""

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.catalog.facts import elbow_facts, fit_facts, rank_facts
from flowlens.catalog.flows import (
    CUT_LABELS, CUTS, EXTRA_FIELDS, ODD_LINE, SPARK_WORDS, drifting_lines, events_table, flow_lines,
    flows, line_parts, typed_lines,
)
from flowlens.functions.anomaly_columns import vector_text
from flowlens.operators.boundaries import cluster_boundaries
from flowlens.operators.boundary_sketches import (
    SKETCH_K, append_sketches, rank_error, read_sketches, refreshed, united,
)
from flowlens.operators.clustering import (
    assign, centers_table, clustering_cost, elbow_curve_pinned, first_centers, fit_clusters,
    pinned_sweep, refine_centers,
)
from flowlens.operators.connections import (
    PORT_SKETCHES, SKETCHES, connection_features, fill_counters,
)
from flowlens.operators.detector import Detector, anomaly_documents, boundaries_table
from flowlens.operators.moments import append_moments, read_moments, scaler_of_moments
from flowlens.operators.rollups import rollup, within
from flowlens.operators.scaling import fit_scaler, standardize, with_features
from flowlens.operators.sweep import elbow_sweep
from flowlens.plans.elbow import snapshot_and_sweep
from flowlens.plans.evaluation import score_labelled
from flowlens.plans.history import score_history
from flowlens.plans.learning import detector_path, distances_table, run_path, train
from flowlens.schemas import EXPORTER_SUMS, FEATURES, KEYS, LABELS
from flowlens.sinks.tables import append_anomalies, append_features, compact_day, write_table
from flowlens.sources.lines import file_lines, keep_netflow, netflow_events, rejected_lines
from flowlens.sources.variants import field_types, field_values, variant_events
from flowlens.sources.tables import (
    read_anomalies, read_features, read_labelled_csv, read_training_set, rejected_labelled_rows,
)
from flowlens.streaming.capture import capture_features
from flowlens.streaming.growing import capture_growing, latest_windows
from flowlens.streaming.scoring import score_stream, score_windows
from flowlens.streaming.windowed import capture_windows
from flowlens.workspace import work_path

DAY = 86400
K, STEPS, PERCENTILE = 5, 3, 92
SWEEP_KS, SWEEP_STEPS = range(2, 61), 2
FIRST_DAY, LAST_DAY = "2024-01-10", "2024-01-15"
TRAIN_LAST_DAY, SCORE_FIRST_DAY = "2024-01-20", "2024-01-21"
SEGMENT = "10:05:00"
LINE_KEYS = ["src_ip", "dst_ip", "end_time", "src_port"]


def rounded(column: Column | str, digits: int = 6) -> Column:
    return F.round(column, digits)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection_features(flows(spark, sf_dir), DAY)


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_table(daily(spark, sf_dir), work_path(spark, "training"))


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = training_set(spark, sf_dir)
    return standardize(table, fit_scaler(table))


def pinned_centers(table: DataFrame) -> list[list[float]]:
    return refine_centers(table, first_centers(table, K), STEPS)


def pinned_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = standardized(spark, sf_dir)
    return assign(table, pinned_centers(table))


def pinned_detector(spark: SparkSession, sf_dir: str) -> tuple[Detector, DataFrame]:
    table = training_set(spark, sf_dir)
    return train(table, K, PERCENTILE, steps=STEPS), table


def long_vector(table: DataFrame, column: str, *others: str) -> DataFrame:
    return table.select(*KEYS, *others, F.posexplode(column).alias("idx", "value"))


def connection_features_query(spark, sf_dir):
    return connection_features(flows(spark, sf_dir))


def connection_features_batch(spark, sf_dir):
    return connection_features(flows(spark, sf_dir), segment=SEGMENT)


def connection_features_no_stats(spark, sf_dir):
    return connection_features(flows(spark, sf_dir).drop(*EXPORTER_SUMS.values()))


def na_fill_zero(spark, sf_dir):
    holes = daily(spark, sf_dir).withColumns(
        {c: F.nullif(F.col(c), F.lit(0)) for c in FEATURES})
    return fill_counters(holes)


def netflow_prefilter(spark, sf_dir):
    kept = keep_netflow(flow_lines(spark, sf_dir))
    return kept.select(*[F.get_json_object("value", f"$.{c}").alias(c) for c in LINE_KEYS])


def flow_json_parse(spark, sf_dir):
    return netflow_events(flow_lines(spark, sf_dir))


def history_day_range(spark, sf_dir):
    path = work_path(spark, "features")
    append_features(daily(spark, sf_dir), path)
    return read_features(spark, path, FIRST_DAY, LAST_DAY)


def partitioned_table_roundtrip(spark, sf_dir):
    """Two loads, the second one run twice."""
    path = work_path(spark, "features")
    table = daily(spark, sf_dir)
    append_features(table.where(F.col("day") < FIRST_DAY), path, "first")
    for _ in range(2):
        append_features(table.where(F.col("day") >= FIRST_DAY), path, "second")
    return read_features(spark, path)


def training_set_roundtrip(spark, sf_dir):
    path = work_path(spark, "training")
    write_table(daily(spark, sf_dir), path)
    return read_training_set(spark, path)


def feature_vector(spark, sf_dir):
    return long_vector(with_features(daily(spark, sf_dir)), "features")


def scaler_stats(spark, sf_dir):
    table = fit_scaler(daily(spark, sf_dir)).to_table(spark)
    return table.select("idx", "feature", rounded("mean").alias("mean"),
                        rounded("std").alias("std"))


def standardized_features(spark, sf_dir):
    long = long_vector(standardized(spark, sf_dir), "normalizedFeatures")
    return long.withColumn("value", rounded("value"))


FIT_K = 11


def cluster_fit(spark, sf_dir):
    """Facts about a fit from a random start: clusters, rows, nearest centres, cost."""
    table = standardized(spark, sf_dir)
    fit = fit_clusters(table, FIT_K)
    model = fit.model.setFeaturesCol("vector").setPredictionCol("other")
    scored = model.transform(assign(table, fit.centers).withColumn(
        "vector", array_to_vector("normalizedFeatures")))
    return fit_facts(scored, len(fit.centers), fit.cost)


def train_then_score(spark, sf_dir):
    """The whole training from a random start, and the ranks of its boundaries."""
    table = training_set(spark, sf_dir)
    detector = train(table, FIT_K, PERCENTILE)
    return rank_facts(detector.flags(table), PERCENTILE)


def detector_from_model(spark, sf_dir):
    """A stored detector and the one put together from its Spark ML model: the same?"""
    root = work_path(spark, "models")
    trained = train(training_set(spark, sf_dir), K, PERCENTILE, root)
    path = detector_path(root, K, PERCENTILE)
    version = spark.read.parquet(f"{path}/versions").agg(F.max("version")).first()[0]
    built = Detector.from_model(spark, f"{run_path(path, version)}/model",
                                trained.scaler.to_table(spark),
                                boundaries_table(spark, trained.boundaries))
    loaded = Detector.load(spark, path)
    scored = spark.read.parquet(f"{run_path(path, version)}/distances")
    return scored.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.lit(len(built.centers)).alias("k"),
                      F.lit(built == loaded == trained).alias("same"))


def cluster_fit_pinned(spark, sf_dir):
    centers = centers_table(spark, pinned_centers(standardized(spark, sf_dir)))
    long = centers.select("prediction", F.posexplode("center").alias("idx", "value"))
    return long.withColumn("value", rounded("value"))


def nearest_center_query(spark, sf_dir):
    return pinned_scored(spark, sf_dir).select(*KEYS, "prediction")


def center_distance(spark, sf_dir):
    return pinned_scored(spark, sf_dir).select(*KEYS, rounded("distance").alias("distance"))


def clustering_cost_query(spark, sf_dir):
    cost = clustering_cost(pinned_scored(spark, sf_dir))
    return cost.select(rounded("cost", 4).alias("cost"))


def elbow_curve_query(spark, sf_dir):
    """All of 2..60 from a random start, and a second pass over the stored centres."""
    table = with_features(training_set(spark, sf_dir))
    clusters = write_table(elbow_sweep(table).clusters(spark), work_path(spark, "clusters"))
    return elbow_facts(clusters, table)


def elbow_points_roundtrip(spark, sf_dir):
    root = work_path(spark, "elbow")
    snapshot_and_sweep(daily(spark, sf_dir), root, scaled=True, steps=SWEEP_STEPS)
    return spark.read.parquet(f"{root}/elbow_points").withColumn("cost", rounded("cost", 4))


def elbow_curve_pinned_query(spark, sf_dir):
    points = elbow_curve_pinned(standardized(spark, sf_dir), SWEEP_KS, SWEEP_STEPS)
    return points.withColumn("cost", rounded("cost", 4))


def elbow_shared_scan(spark, sf_dir):
    """Rows and cost of all 1,829 centres of the sweep."""
    sweep = pinned_sweep(standardized(spark, sf_dir), SWEEP_KS, SWEEP_STEPS)
    return sweep.clusters(spark).drop("center").withColumn("cost", rounded("cost", 4))


def boundaries(spark, sf_dir, **options):
    found = cluster_boundaries(pinned_scored(spark, sf_dir), PERCENTILE, **options)
    return found.withColumn("boundary", rounded("boundary"))


def cluster_boundaries_query(spark, sf_dir):
    return boundaries(spark, sf_dir)


def cluster_boundaries_narrowed(spark, sf_dir):
    """Many rounds, each with few parts."""
    return boundaries(spark, sf_dir, bins=4)


def cluster_boundaries_approx(spark, sf_dir):
    return boundaries(spark, sf_dir, method="approx", accuracy=1_000_000)


def distances_table_query(spark, sf_dir):
    path = work_path(spark, "distances")
    table = write_table(distances_table(pinned_scored(spark, sf_dir)), path)
    return table.select(
        *KEYS, "predictions", rounded("distances").alias("distances"),
        F.posexplode(F.arrays_zip("features", "normalizedFeatures")).alias("idx", "pair"),
    ).select(*KEYS, "predictions", "distances", "idx", F.col("pair.features").alias("value"),
             rounded("pair.normalizedFeatures").alias("normalized"))


def anomaly_filter(spark, sf_dir):
    detector, table = pinned_detector(spark, sf_dir)
    return detector.outliers(table).select(
        *KEYS, "prediction", rounded("distance").alias("distance"),
        rounded("boundary").alias("boundary"))


def anomaly_flags(spark, sf_dir):
    detector, table = pinned_detector(spark, sf_dir)
    return detector.flags(table).select(*KEYS, "prediction", "pred_anom")


def anomaly_probability(spark, sf_dir):
    detector, table = pinned_detector(spark, sf_dir)
    return detector.outliers(table).select(
        *KEYS, rounded("probability", 4).alias("probability"))


def rounded_records(anomalies: DataFrame) -> DataFrame:
    return anomalies.withColumn("probability", rounded("probability", 4))


def anomaly_records_query(spark, sf_dir):
    detector, table = pinned_detector(spark, sf_dir)
    return rounded_records(detector.anomalies(table))


def anomaly_documents_query(spark, sf_dir):
    detector, table = pinned_detector(spark, sf_dir)
    return anomaly_documents(detector.anomalies(table), digits=4)


def anomaly_table_roundtrip(spark, sf_dir):
    detector, table = pinned_detector(spark, sf_dir)
    path = work_path(spark, "anomalies")
    for _ in range(2):
        append_anomalies(detector.anomalies(table), path, "load")
    return rounded_records(read_anomalies(spark, path))


def artifact_roundtrip(spark, sf_dir):
    """Every number of a detector that was saved and loaded."""
    trained, _ = pinned_detector(spark, sf_dir)
    path = work_path(spark, "detector")
    trained.save(spark, path)
    detector = Detector.load(spark, path)
    scaler = detector.scaler.to_table(spark)
    centers = centers_table(spark, detector.centers)
    parts = [
        scaler.select(F.lit("mean").alias("part"), F.lit(0).alias("id"), "idx",
                      F.col("mean").alias("value")),
        scaler.select(F.lit("std"), F.lit(0), "idx", "std"),
        centers.select(F.lit("center"), "prediction", F.posexplode("center")),
        boundaries_table(spark, detector.boundaries).select(
            F.lit("boundary"), "prediction", F.lit(0), "boundary"),
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.union(part)
    return table.withColumn("value", rounded("value"))


def train_then_score_pinned(spark, sf_dir):
    path = work_path(spark, "features")
    append_features(daily(spark, sf_dir), path)
    detector = train(read_features(spark, path, None, TRAIN_LAST_DAY), K, PERCENTILE, steps=STEPS)
    rest = read_features(spark, path, SCORE_FIRST_DAY)
    return rounded_records(detector.anomalies(rest))


def history_anomalies(spark, sf_dir):
    features, found = work_path(spark, "features"), work_path(spark, "anomalies")
    append_features(daily(spark, sf_dir), features)
    detector = train(read_features(spark, features), K, PERCENTILE, steps=STEPS)
    score_history(spark, features, detector, FIRST_DAY, LAST_DAY, found)
    return rounded_records(read_anomalies(spark, found))


def write_labelled_csv(table: DataFrame, path: str) -> None:
    """Features with a deterministic truth, as quoted CSV."""
    odd = F.col("n_octetos") > 20000
    labelled = table.select(
        "src_ip", "dst_ip", "tsegm_inittime", "week_day", "day", *FEATURES,
        odd.cast("string").alias("anomaly"),
        F.when(odd, "volume").alias("anomaly_type"),
        F.when(odd, "n_octetos").alias("anomalous_var"))
    labelled.write.csv(path, header=True, quoteAll=True, nullValue="", emptyValue="")


def labelled_csv(spark, sf_dir) -> DataFrame:
    path = work_path(spark, "labelled")
    write_labelled_csv(daily(spark, sf_dir), path)
    return read_labelled_csv(spark, path)


def labelled_csv_parse(spark, sf_dir):
    return labelled_csv(spark, sf_dir)


def labelled_csv_rejected(spark, sf_dir):
    """Rows with text or NaN for a number, by their keys."""
    path = work_path(spark, "labelled")
    table = daily(spark, sf_dir)
    bad = (F.when(F.col("n_paquets") % 3 == 0, "oops").when(F.col("n_paquets") % 3 == 1, "NaN")
           .otherwise(F.col("n_paquets").cast("string")))
    write_labelled_csv(table.withColumn("n_paquets", bad), path)
    fields = F.split(F.regexp_replace("row", '"', ""), ",")
    return rejected_labelled_rows(spark, path).select(
        *[fields[i].alias(c) for i, c in enumerate(
            ("src_ip", "dst_ip", "tsegm_inittime", "week_day", "day"))])


def labelled_columns(scored: DataFrame) -> DataFrame:
    return scored.select(
        *KEYS, vector_text(F.col("features")).alias("features"), "predictions",
        rounded("distances").alias("distances"), rounded("boundary").alias("boundary"),
        "pred_anom", *LABELS)


def labelled_scoring(spark, sf_dir):
    detector, _ = pinned_detector(spark, sf_dir)
    return labelled_columns(score_labelled(labelled_csv(spark, sf_dir), detector))


def labelled_result_roundtrip(spark, sf_dir):
    detector, _ = pinned_detector(spark, sf_dir)
    path = work_path(spark, "labelled_result")
    score_labelled(labelled_csv(spark, sf_dir), detector).write.parquet(path)
    return labelled_columns(spark.read.parquet(path))


def flow_json_typed(spark, sf_dir):
    """Numbers as text and with a fraction give the same events."""
    return netflow_events(typed_lines(events_table(spark, sf_dir)))


def flow_json_rejected(spark, sf_dir):
    lines = events_table(spark, sf_dir).selectExpr(f"{ODD_LINE.format(**SPARK_WORDS)} AS value")
    return rejected_lines(lines)


def compacted_table_roundtrip(spark, sf_dir):
    """Four loads of every day; some days rewritten as one load, one of them twice."""
    path = work_path(spark, "features")
    table = daily(spark, sf_dir)
    share = F.pmod(F.xxhash64("src_ip"), F.lit(4))
    for load in range(4):
        append_features(table.where(share == load), path, f"load{load}")
    for day in (FIRST_DAY, LAST_DAY, FIRST_DAY):
        compact_day(spark, path, day, keep_replaced=day == LAST_DAY)
    return read_features(spark, path)


def feed(spark, sf_dir, start: Callable[[DataFrame], StreamingQuery],
         cuts: list[str] = CUTS) -> None:
    """Write the lines part by part, in order of time, and let the stream take each.

    A part is a folder of as many files as its tasks write, and one micro-batch that as
    many tasks read. Every run goes on from the same checkpoint.
    """
    path = work_path(spark, "lines")
    for i, part in enumerate(line_parts(flow_lines(spark, sf_dir), cuts)):
        part.write.text(f"{path}/{i}")
        start(file_lines(spark, f"{path}/*", True)).awaitTermination()


def state_partitions(spark: SparkSession) -> int | None:
    """Partitions of a stream's state: on a cluster as many as the session's shuffles have.

    A local session leaves the choice to the stream.
    """
    if spark.sparkContext.master.startswith("local["):
        return None
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def label_of_each_batch() -> Callable[[], str]:
    labels = iter(CUT_LABELS)
    return lambda: next(labels)


def stream_features_available_now(spark, sf_dir):
    """Four micro-batches, each an interval with a label of its own."""
    table, checkpoint = work_path(spark, "features"), work_path(spark, "checkpoint")
    label = label_of_each_batch()
    feed(spark, sf_dir, lambda lines: capture_features(
        lines, table, checkpoint, label, available_now=True))
    return read_features(spark, table)


def stream_features_windowed(spark, sf_dir, cuts: list[str] = CUTS):
    """Day windows over several micro-batches; those closed when the input ends."""
    table, checkpoint = work_path(spark, "windowed"), work_path(spark, "checkpoint")
    feed(spark, sf_dir, lambda lines: capture_windows(
        netflow_events(lines), table, checkpoint, DAY,
        state_partitions=state_partitions(spark), available_now=True), cuts)
    return read_features(spark, table)


def stream_windows_growing(spark, sf_dir, cuts: list[str] = CUTS):
    """The last row of every day window, open ones too, while micro-batches correct them."""
    table, checkpoint = work_path(spark, "growing"), work_path(spark, "checkpoint")
    feed(spark, sf_dir, lambda lines: capture_growing(
        netflow_events(lines), table, checkpoint, DAY,
        state_partitions=state_partitions(spark), available_now=True), cuts)
    return latest_windows(spark, table).drop("closed")


def stream_score_available_now(spark, sf_dir):
    detector, _ = pinned_detector(spark, sf_dir)
    table, checkpoint = work_path(spark, "anomalies"), work_path(spark, "checkpoint")
    label = label_of_each_batch()
    feed(spark, sf_dir, lambda lines: score_stream(
        lines, detector, table, checkpoint, label, available_now=True))
    return rounded_records(read_anomalies(spark, table))


def stream_score_windowed(spark, sf_dir, cuts: list[str] = CUTS):
    detector, _ = pinned_detector(spark, sf_dir)
    table, checkpoint = work_path(spark, "anomalies"), work_path(spark, "checkpoint")
    feed(spark, sf_dir, lambda lines: score_windows(
        netflow_events(lines), detector, table, checkpoint, DAY,
        state_partitions=state_partitions(spark), available_now=True), cuts)
    return rounded_records(read_anomalies(spark, table))


LG_K = 12


def stored_sketches(spark, sf_dir):
    """Five-minute features with sketches, stored; rollups read these and no event."""
    table = connection_features(flows(spark, sf_dir), lg_k=LG_K)
    return write_table(table, work_path(spark, "sketches"))


def with_exact_ports(rolled: DataFrame, exact: DataFrame, keys: list[str]) -> DataFrame:
    """The rollup's sums, the exact port counts, and whether its estimates are near them."""
    ports = exact.select(*keys, *[F.col(c).alias(f"exact_{c}") for c in PORT_SKETCHES])
    same = rolled.join(ports, [rolled[k].eqNullSafe(ports[k]) for k in keys])
    return same.select(
        *[rolled[c] for c in rolled.columns if c not in (*PORT_SKETCHES, *SKETCHES)],
        *[F.col(f"exact_{c}").alias(c) for c in PORT_SKETCHES],
        *[within(rolled[c], F.col(f"exact_{c}"), LG_K).alias(f"{c}_near")
          for c in PORT_SKETCHES])


def connection_rollup(spark, sf_dir):
    """Five minutes to days, without events."""
    rolled = rollup(stored_sketches(spark, sf_dir), DAY)
    return with_exact_ports(rolled, daily(spark, sf_dir), KEYS)


def address_rollup(spark, sf_dir):
    """Days to all time, and pairs to source addresses: a rollup of a rollup."""
    by_day = rollup(stored_sketches(spark, sf_dir), DAY)
    rolled = rollup(write_table(by_day, work_path(spark, "by_day")), None, ["src_ip"])
    exact = flows(spark, sf_dir).groupBy("src_ip").agg(
        F.count_distinct("src_port").alias("n_src_port"),
        F.count_distinct("dst_port").alias("n_dst_port"))
    return with_exact_ports(rolled, exact, ["src_ip"])


LOADS = 4


def in_loads(table: DataFrame) -> list[DataFrame]:
    """The rows in four parts."""
    part = F.pmod(F.xxhash64("src_ip", "dst_ip"), F.lit(LOADS))
    return [table.where(part == i) for i in range(LOADS)]


def boundaries_refreshed(spark, sf_dir):
    """Boundaries of a range of days from four loads' sketches, and the ranks they have."""
    detector, table = pinned_detector(spark, sf_dir)
    path = work_path(spark, "distance_sketches")
    for i, rows in enumerate([*in_loads(table), in_loads(table)[0]]):
        append_sketches(rows, detector, path, f"load{i % LOADS}")
    sketches = read_sketches(spark, path, detector, FIRST_DAY, LAST_DAY)
    found = refreshed(sketches, detector, PERCENTILE)
    days = detector.score(table.where(F.col("day").between(FIRST_DAY, LAST_DAY)))
    own = boundaries_table(spark, found.boundaries)
    ranks = days.join(F.broadcast(own), "prediction").groupBy("prediction").agg(
        F.count("distance").alias("n_rows"),
        F.count_if(F.col("distance") < F.col("boundary")).alias("below"),
        F.count_if(F.col("distance") <= F.col("boundary")).alias("upto"))
    share, error = PERCENTILE / 100, F.col("n_rows") * rank_error(SKETCH_K) + 1
    united_rows = united(sketches, PERCENTILE).select("prediction", F.col("n_rows").alias("n"))
    return ranks.join(united_rows, "prediction").select(
        "prediction", "n_rows", (F.col("n") == F.col("n_rows")).alias("all_rows"),
        ((F.col("below") - error <= F.col("n_rows") * share)
         & (F.col("n_rows") * share <= F.col("upto") + error)).alias("rank_near"))


def scaler_from_moments(spark, sf_dir):
    """A scaler of a range of days from four loads' moments, one of them written twice."""
    path = work_path(spark, "moments")
    loads = in_loads(daily(spark, sf_dir))
    for i, rows in enumerate([*loads, loads[1]]):
        append_moments(rows, path, f"load{i if i < LOADS else 1}")
    scaler = scaler_of_moments(read_moments(spark, path, FIRST_DAY, LAST_DAY))
    return scaler.to_table(spark).select("idx", "feature", rounded("mean").alias("mean"),
                                         rounded("std").alias("std"))


def flow_json_schema(spark, sf_dir):
    """Fields, types and declared or not, of lines with fields that come and go."""
    return field_types(drifting_lines(events_table(spark, sf_dir)))


def flow_json_mixed_types(spark, sf_dir):
    """Every type that a field has, of lines with numbers in three forms."""
    return field_values(typed_lines(events_table(spark, sf_dir)))


def flow_json_extra(spark, sf_dir):
    """Events with two fields that no schema declares, from the same parse."""
    lines = drifting_lines(events_table(spark, sf_dir))
    return variant_events(keep_netflow(lines), EXTRA_FIELDS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "connection_features": connection_features_query,
    "connection_features_batch": connection_features_batch,
    "connection_features_no_stats": connection_features_no_stats,
    "na_fill_zero": na_fill_zero,
    "netflow_prefilter": netflow_prefilter,
    "flow_json_parse": flow_json_parse,
    "flow_json_typed": flow_json_typed,
    "flow_json_rejected": flow_json_rejected,
    "flow_json_schema": flow_json_schema,
    "flow_json_mixed_types": flow_json_mixed_types,
    "flow_json_extra": flow_json_extra,
    "history_day_range": history_day_range,
    "partitioned_table_roundtrip": partitioned_table_roundtrip,
    "compacted_table_roundtrip": compacted_table_roundtrip,
    "training_set_roundtrip": training_set_roundtrip,
    "connection_rollup": connection_rollup,
    "address_rollup": address_rollup,
    "feature_vector": feature_vector,
    "scaler_stats": scaler_stats,
    "scaler_from_moments": scaler_from_moments,
    "standardized_features": standardized_features,
    "cluster_fit": cluster_fit,
    "cluster_fit_pinned": cluster_fit_pinned,
    "train_then_score": train_then_score,
    "detector_from_model": detector_from_model,
    "nearest_center": nearest_center_query,
    "center_distance": center_distance,
    "clustering_cost": clustering_cost_query,
    "elbow_curve": elbow_curve_query,
    "elbow_curve_pinned": elbow_curve_pinned_query,
    "elbow_shared_scan": elbow_shared_scan,
    "elbow_points_roundtrip": elbow_points_roundtrip,
    "cluster_boundaries": cluster_boundaries_query,
    "cluster_boundaries_narrowed": cluster_boundaries_narrowed,
    "cluster_boundaries_approx": cluster_boundaries_approx,
    "boundaries_refreshed": boundaries_refreshed,
    "distances_table": distances_table_query,
    "anomaly_filter": anomaly_filter,
    "anomaly_flags": anomaly_flags,
    "anomaly_probability": anomaly_probability,
    "anomaly_records": anomaly_records_query,
    "anomaly_documents": anomaly_documents_query,
    "anomaly_table_roundtrip": anomaly_table_roundtrip,
    "artifact_roundtrip": artifact_roundtrip,
    "train_then_score_pinned": train_then_score_pinned,
    "history_anomalies": history_anomalies,
    "labelled_csv_parse": labelled_csv_parse,
    "labelled_csv_rejected": labelled_csv_rejected,
    "labelled_scoring": labelled_scoring,
    "labelled_result_roundtrip": labelled_result_roundtrip,
    "stream_features_available_now": stream_features_available_now,
    "stream_features_windowed": stream_features_windowed,
    "stream_windows_growing": stream_windows_growing,
    "stream_score_available_now": stream_score_available_now,
    "stream_score_windowed": stream_score_windowed,
}
