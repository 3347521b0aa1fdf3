"""Boundaries that can be refreshed: a sketch of the distances per day and cluster."""

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators.boundaries import check_percentile
from flowlens.operators.detector import Detector
from flowlens.sinks.tables import append_by_load
from flowlens.sources.tables import between_days

#: Size of a sketch: about three times as many numbers at most, whatever the rows.
SKETCH_K = 4096
SCHEMA = "model string, prediction int, n_rows bigint, sketch binary, day date, load_id string"


def rank_error(k: int) -> float:
    """Greatest difference of a sketch's rank from the true one, as a share of the rows (99 %)."""
    return 2.296 / k ** 0.9723


def distance_sketches(scored: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(day, prediction, n_rows, sketch) of rows with day, prediction and distance.

    One pass with partial sketches in every task, so a cluster with most of the rows
    arrives as one sketch per task. Null distances do not count.
    """
    return (scored.where("distance IS NOT NULL").groupBy("day", "prediction")
            .agg(F.count("distance").alias("n_rows"),
                 F.kll_sketch_agg_double("distance", F.lit(k)).alias("sketch")))


def united(sketches: DataFrame, percentile: int) -> DataFrame:
    """(prediction, n_rows, boundary) of the united sketches of every cluster."""
    check_percentile(percentile)
    merged = sketches.groupBy("prediction").agg(
        F.sum("n_rows").alias("n_rows"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select("prediction", "n_rows", F.kll_sketch_get_quantile_double(
        "sketch", F.lit(percentile / 100)).alias("boundary"))


def append_sketches(features: DataFrame, detector: Detector, path: str,
                    load_id: str | None = None, k: int = SKETCH_K) -> None:
    """Score connection features and append their distances' sketches, one load.

    Rows carry the model's id (scaler and centres, not boundaries), because distances to
    other centres cannot be united. A load that runs again under its id replaces itself.
    """
    rows = distance_sketches(detector.score(features), k).withColumn(
        "model", F.lit(detector.model_id()))
    append_by_load(rows, path, load_id)


def read_sketches(spark: SparkSession, path: str, detector: Detector,
                  first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The sketches of this detector's model over the days in [first_day, last_day]."""
    table = spark.read.schema(SCHEMA).parquet(path)
    return between_days(table.where(F.col("model") == detector.model_id()), first_day, last_day)


def refreshed(sketches: DataFrame, detector: Detector, percentile: int) -> Detector:
    """The detector with boundaries from stored sketches; no distance is read again.

    A cluster that no sketch covers keeps the boundary it had.
    """
    rows = united(sketches, percentile).collect()
    found = {r["prediction"]: r["boundary"] for r in rows}
    return replace(detector, boundaries=detector.boundaries | found)
