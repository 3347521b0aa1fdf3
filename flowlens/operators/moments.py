"""Mean and spread of the counters per day, so that a scaler for any days reads a small table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators.scaling import Scaler
from flowlens.schemas import FEATURES
from flowlens.sinks.tables import append_by_load
from flowlens.sources.tables import between_days

SCHEMA = ("n bigint, " + ", ".join(f"mean_{c} double, squares_{c} double" for c in FEATURES)
          + ", day date, load_id string")


def day_moments(features: DataFrame) -> DataFrame:
    """(day, n, mean and sum of squared differences from it of every counter)."""
    return features.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"avg({c}) AS mean_{c}") for c in FEATURES],
        *[F.expr(f"var_pop({c}) * count({c}) AS squares_{c}") for c in FEATURES])


def append_moments(features: DataFrame, path: str, load_id: str | None = None) -> None:
    """Append a load's moments; a load that runs again under its id replaces itself."""
    append_by_load(day_moments(features), path, load_id)


def read_moments(spark: SparkSession, path: str, first_day: str | None = None,
                 last_day: str | None = None) -> DataFrame:
    return between_days(spark.read.schema(SCHEMA).parquet(path), first_day, last_day)


def scaler_of_moments(moments: DataFrame) -> Scaler:
    """The scaler of all rows that the moments stand for.

    The mean of all is the weighted mean of the parts; each part adds its own squares and
    its rows times the squared difference of its mean. No sum of squares of the values
    themselves is taken, so nothing cancels. Two passes over one row per day and load.
    """
    total = moments.agg(F.sum("n").alias("n"), *[
        (F.sum(F.col("n") * F.col(f"mean_{c}")) / F.sum("n")).alias(c) for c in FEATURES]).first()
    if not total["n"]:
        raise ValueError("cannot make a scaler of no rows")
    spread = moments.agg(*[
        F.sum(F.col(f"squares_{c}") + F.col("n") * (F.col(f"mean_{c}") - total[c])
              * (F.col(f"mean_{c}") - total[c])).alias(c) for c in FEATURES]).first()
    free = total["n"] - 1
    return Scaler(tuple(total[c] for c in FEATURES),
                  tuple((spread[c] / free) ** 0.5 if free else 0.0 for c in FEATURES))
