"""Stored tables of connection features, training sets, anomalies and labelled rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.operators.connections import fill_counters
from flowlens.schemas import (
    ANOMALY_COLUMNS, ANOMALY_SCHEMA, FEATURE_SCHEMA, FEATURES, KEYS, LABELLED_SCHEMA,
)
from flowlens.sources.loads import current_loads


def between_days(table: DataFrame, first_day: str | None, last_day: str | None,
                 kind: str = "date") -> DataFrame:
    """Rows of the days in [first_day, last_day].

    ``day`` is the partition column, so the range prunes folders before any file is read.
    """
    if first_day is not None:
        table = table.where(F.col("day") >= F.lit(first_day).cast(kind))
    if last_day is not None:
        table = table.where(F.col("day") <= F.lit(last_day).cast(kind))
    return table


def select_days(table: DataFrame, first_day: str | None = None,
                last_day: str | None = None) -> DataFrame:
    """Keys and counters of the days in [first_day, last_day], null counters as 0."""
    return fill_counters(between_days(table, first_day, last_day).select(*KEYS, *FEATURES))


def read_features(spark: SparkSession, path: str, first_day: str | None = None,
                  last_day: str | None = None) -> DataFrame:
    """Keys and counters of a table by day and load, each compacted day once."""
    table = spark.read.schema(FEATURE_SCHEMA).parquet(path)
    return select_days(current_loads(table, path), first_day, last_day)


def read_training_set(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURE_SCHEMA).parquet(path)


def read_anomalies(spark: SparkSession, path: str, first_day: str | None = None,
                   last_day: str | None = None) -> DataFrame:
    table = current_loads(spark.read.schema(ANOMALY_SCHEMA).parquet(path), path)
    return between_days(table.select(*ANOMALY_COLUMNS), first_day, last_day, "string")


BROKEN = "_broken"


def _labelled_rows(spark: SparkSession, path: str) -> tuple[DataFrame, Column]:
    """Rows with the text of malformed ones, and whether a row is unusable."""
    schema = T.StructType([*LABELLED_SCHEMA, T.StructField(BROKEN, T.StringType())])
    rows = spark.read.csv(path, schema=schema, header=True, enforceSchema=True,
                          ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
                          columnNameOfCorruptRecord=BROKEN)
    unusable = F.col(BROKEN).isNotNull()
    for name in FEATURES:
        unusable = unusable | F.col(name).isNull() | F.isnan(name)
    return rows, unusable


def read_labelled_csv(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """Feature rows with truth labels; numbers may be quoted, an empty label is null.

    A row with a number that cannot be read, is missing or is no number, or with too few
    or too many fields, stops the job; with ``on_bad="drop"`` it is left out, and
    ``rejected_labelled_rows`` gives it.
    """
    if on_bad not in ("fail", "drop"):
        raise ValueError("on_bad must be 'fail' or 'drop'")
    rows, unusable = _labelled_rows(spark, path)
    if on_bad == "drop":
        rows = rows.where(~unusable)
    else:
        text = F.coalesce(BROKEN, F.concat_ws(",", *LABELLED_SCHEMA.names))
        checked = F.when(unusable, F.raise_error(F.concat(F.lit("unusable row: "), text))
                         .cast("string")).otherwise(F.col(LABELLED_SCHEMA.names[0]))
        rows = rows.withColumn(LABELLED_SCHEMA.names[0], checked)
    return rows.select(*LABELLED_SCHEMA.names)


def rejected_labelled_rows(spark: SparkSession, path: str) -> DataFrame:
    """(row): the text of every unusable row; of one that only holds a NaN, its fields."""
    rows, unusable = _labelled_rows(spark, path)
    text = F.coalesce(BROKEN, F.concat_ws(",", *LABELLED_SCHEMA.names))
    return rows.where(unusable).select(text.alias("row"))
