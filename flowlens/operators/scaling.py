"""Mean and standard deviation per counter, and z-scores."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.schemas import FEATURES


@dataclass(frozen=True)
class Scaler:
    mean: tuple[float, ...]
    std: tuple[float, ...]

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, name, self.mean[i], self.std[i]) for i, name in enumerate(FEATURES)]
        return spark.createDataFrame(rows, "idx int, feature string, mean double, std double")

    @staticmethod
    def from_table(table: DataFrame) -> "Scaler":
        rows = table.orderBy("idx").select("mean", "std").limit(len(FEATURES) + 1).collect()
        if len(rows) != len(FEATURES):
            raise ValueError(f"a scaler has {len(FEATURES)} rows")
        return Scaler(tuple(r["mean"] for r in rows), tuple(r["std"] for r in rows))


def fit_scaler(table: DataFrame) -> Scaler:
    """One pass, one row to the driver. A single row has standard deviation 0."""
    row = table.selectExpr(
        *[f"avg({c}) AS mean_{c}" for c in FEATURES],
        *[f"stddev_samp({c}) AS std_{c}" for c in FEATURES],
    ).first()
    if row[f"mean_{FEATURES[0]}"] is None:
        raise ValueError("cannot fit a scaler on an empty table")
    return Scaler(tuple(row[f"mean_{c}"] for c in FEATURES),
                  tuple(row[f"std_{c}"] or 0.0 for c in FEATURES))


def _as_double(counter: str) -> str:
    return f"coalesce(CAST({counter} AS DOUBLE), 0D)"


def feature_array() -> Column:
    return F.expr("array(" + ", ".join(map(_as_double, FEATURES)) + ")")


def with_features(table: DataFrame) -> DataFrame:
    """Replace the twenty counters by ``features: array<double>``."""
    return table.withColumn("features", feature_array()).drop(*FEATURES)


def standardized_array(scaler: Scaler) -> Column:
    """z-scores; a counter that never varied becomes 0."""
    scores = ["0D" if std == 0.0
              else f"({_as_double(c)} - ({float(mean)!r}D)) / {float(std)!r}D"
              for c, mean, std in zip(FEATURES, scaler.mean, scaler.std)]
    return F.expr("array(" + ", ".join(scores) + ")")


def standardize(table: DataFrame, scaler: Scaler) -> DataFrame:
    """Replace the counters by the arrays ``features`` and ``normalizedFeatures``."""
    return table.withColumns({
        "features": feature_array(),
        "normalizedFeatures": standardized_array(scaler),
    }).drop(*FEATURES)
