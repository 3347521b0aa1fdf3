"""Table writers."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.sources.loads import COMPACTED, COMPACTION_LIST, COMPACTIONS, current_loads
from flowlens.workspace import remove


def _write_load(table: DataFrame, path: str, load_id: str | None, partitions: list[str]) -> None:
    load_id = load_id or uuid.uuid4().hex
    (table.withColumn("load_id", F.lit(load_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions, "load_id").parquet(path))


def append_by_load(table: DataFrame, path: str, load_id: str | None = None) -> None:
    """Append a summary of few rows, one folder per load; the same load id replaces its load."""
    _write_load(table.hint("rebalance"), path, load_id, [])


def append_features(table: DataFrame, path: str, load_id: str | None = None) -> None:
    """Append connection features, one folder per day and load.

    A load that runs again under its id replaces its own rows and no others, so a retried
    job or replayed micro-batch leaves no duplicates. The rebalance hint joins small
    writer partitions and splits a day that is too big for one.
    """
    _write_load(table.hint("rebalance", "day"), path, load_id, ["day"])


def append_anomalies(anomalies: DataFrame, path: str, load_id: str | None = None) -> None:
    """Append anomaly rows, one folder per day and load; the same load id replaces its load."""
    _write_load(anomalies.hint("rebalance", "day"), path, load_id, ["day"])


def compact_day(spark: SparkSession, path: str, day: str, keep_replaced: bool = False) -> str:
    """Rewrite a closed day of a feature or anomaly table as one load of few large files.

    Three steps, and a reader gets the whole day, once, before, between and after them:
    the rows are written beside the day's loads, as a load that readers skip; one row of
    the table's list of compactions, which appears with the commit of its file, makes that
    load count instead of those it replaces; then those are removed. ``keep_replaced``
    leaves them to ``remove_replaced``, for readers that listed the files before and still
    read them. A run that fails before the second step changes nothing and can be repeated.
    Compact a day by one job at a time, and closed days only. Returns the new load's id.
    """
    path = path.rstrip("/")
    load_id = f"{COMPACTED}{uuid.uuid4().hex}"
    day_rows = spark.read.option("basePath", path).parquet(f"{path}/day={day}")
    rows = current_loads(day_rows, path)
    replaced = [r["load_id"] for r in rows.select("load_id").distinct().collect()]
    rows.drop("day", "load_id").hint("rebalance").write.parquet(
        f"{path}/day={day}/load_id={load_id}")
    _commit_compaction(spark, path, day, load_id, replaced)
    if not keep_replaced:
        remove_replaced(spark, path, day)
    return load_id


def _commit_compaction(spark: SparkSession, path: str, day: str, load_id: str,
                       replaced: list[str]) -> None:
    row = spark.createDataFrame([(day, load_id, replaced)], COMPACTIONS)
    row.coalesce(1).write.mode("append").parquet(f"{path}/{COMPACTION_LIST}")


def remove_replaced(spark: SparkSession, path: str, day: str) -> None:
    """Delete the loads of a day that a compaction has replaced; readers skip them already."""
    path = path.rstrip("/")
    listed = spark.read.schema(COMPACTIONS).parquet(f"{path}/{COMPACTION_LIST}")
    old = listed.where(F.col("day") == day).select(F.explode("replaces").alias("load_id"))
    for row in old.distinct().collect():
        remove(spark, f"{path}/day={day}/load_id={row['load_id']}")


def write_table(table: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Store a table and return it as read back."""
    table.write.mode(mode).parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def write_small_table(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One file; for results of a few rows only."""
    table.coalesce(1).write.mode(mode).parquet(path)
