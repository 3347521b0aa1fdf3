"""A trained detector: scaler, centres and boundaries; scores connection features."""

import hashlib
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions import anomaly_columns as ac
from flowlens.operators.clustering import assign, load_ml_centers
from flowlens.operators.scaling import Scaler, standardize
from flowlens.schemas import ANOMALY_COLUMNS, DOCUMENT_FIELDS, FEATURES
from flowlens.workspace import exists

PARTS = "part string, id int, idx int, value double"


@dataclass(frozen=True)
class Detector:
    """Small by construction: 40 numbers of the scaler, k centres, at most k boundaries."""

    scaler: Scaler
    centers: list[list[float]]
    boundaries: dict[int, float]

    def score(self, table: DataFrame) -> DataFrame:
        """Replace the counters by features, normalizedFeatures, prediction, distance."""
        return assign(standardize(table, self.scaler), self.centers)

    def with_boundary(self, scored: DataFrame, how: str = "inner") -> DataFrame:
        """Add the cluster's boundary, looked up by cluster id (at most k rows)."""
        table = boundaries_table(scored.sparkSession, self.boundaries)
        return scored.join(F.broadcast(table), "prediction", how)

    def flags(self, table: DataFrame) -> DataFrame:
        """All rows, scored, with ``boundary`` and ``pred_anom``."""
        return (self.with_boundary(self.score(table), "left")
                .withColumn("pred_anom", ac.is_anomaly()))

    def outliers(self, table: DataFrame) -> DataFrame:
        """Rows outside their cluster's boundary, with ``probability``."""
        return (self.with_boundary(self.score(table))
                .where(F.col("distance") > F.col("boundary"))
                .withColumn("probability", ac.probability()))

    def anomalies(self, table: DataFrame, event_type: str = ac.EVENT_TYPE) -> DataFrame:
        """The anomaly table's rows."""
        return anomaly_records(self.outliers(table), event_type)

    def model_id(self) -> str:
        """Names scaler and centres: the same for detectors that differ in boundaries only."""
        numbers = [*self.scaler.mean, *self.scaler.std, *(v for c in self.centers for v in c)]
        return hashlib.sha256(",".join(float(v).hex() for v in numbers).encode()).hexdigest()

    def parts(self, spark: SparkSession) -> DataFrame:
        """All numbers as rows (part, id, idx, value)."""
        rows = [(name, 0, i, float(v)) for name, values in
                (("mean", self.scaler.mean), ("std", self.scaler.std)) for i, v in enumerate(values)]
        rows += [("center", i, j, float(v)) for i, c in enumerate(self.centers)
                 for j, v in enumerate(c)]
        rows += [("boundary", i, 0, float(v)) for i, v in self.boundaries.items()]
        return spark.createDataFrame(rows, PARTS)

    @staticmethod
    def of_parts(rows: list) -> "Detector":
        own = {name: {} for name in ("mean", "std", "center", "boundary")}
        for r in rows:
            own[r["part"]][r["id"], r["idx"]] = r["value"]
        mean, std = (tuple(v for _, v in sorted(own[name].items())) for name in ("mean", "std"))
        k = 1 + max((i for i, _ in own["center"]), default=-1)
        centers = [[v for (i, _), v in sorted(own["center"].items()) if i == c] for c in range(k)]
        if (len(mean), len(std)) != (len(FEATURES),) * 2 or not all(
                len(c) == len(FEATURES) for c in centers):
            raise ValueError("not a whole detector")
        return Detector(Scaler(mean, std), centers,
                        {i: v for (i, _), v in own["boundary"].items()})

    def save(self, spark: SparkSession, path: str, mode: str = "errorifexists",
             version: str | None = None) -> str:
        """Add a version below ``path`` and return its name.

        All parts are one file, which appears with the job's commit: a reader gets the old
        version or the new one, whole, and a save that fails half-way leaves the old one.
        ``overwrite`` adds a version beside the ones that are there.
        """
        if mode not in ("errorifexists", "overwrite"):
            raise ValueError("mode must be 'errorifexists' or 'overwrite'")
        table = f"{path.rstrip('/')}/versions"
        if mode == "errorifexists" and exists(spark, table):
            raise FileExistsError(f"a detector already exists at {path}")
        version = version or new_version()
        (self.parts(spark).withColumn("version", F.lit(version)).coalesce(1)
         .write.mode("append").parquet(table))
        return version

    @staticmethod
    def newest(spark: SparkSession, path: str) -> str:
        """The name of the newest version."""
        table = spark.read.schema(f"version string, {PARTS}").parquet(
            f"{path.rstrip('/')}/versions")
        return table.agg(F.max("version")).first()[0]

    @staticmethod
    def load(spark: SparkSession, path: str, version: str | None = None) -> "Detector":
        """The newest version, or the one named."""
        table = spark.read.schema(f"version string, {PARTS}").parquet(
            f"{path.rstrip('/')}/versions")
        if version is None:
            version = Detector.newest(spark, path)
        return Detector.of_parts(table.where(F.col("version") == version).collect())

    @staticmethod
    def from_model(spark: SparkSession, model_path: str, scaler: DataFrame,
                   boundaries: DataFrame) -> "Detector":
        """From a saved Spark ML model, a scaler table and a boundary table.

        ``scaler`` has idx, mean and std; ``boundaries`` has prediction and boundary, at
        most one row per cluster.
        """
        centers = load_ml_centers(model_path)
        rows = boundaries.select("prediction", "boundary").limit(len(centers) + 1).collect()
        found = {r["prediction"]: r["boundary"] for r in rows if r["boundary"] is not None}
        if len(rows) > len(centers) or not set(found) <= set(range(len(centers))):
            raise ValueError("boundaries do not belong to the model")
        return Detector(Scaler.from_table(scaler), centers, found)


def new_version() -> str:
    """A name that sorts by time of making."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def boundaries_table(spark: SparkSession, boundaries: dict[int, float]) -> DataFrame:
    return spark.createDataFrame(sorted(boundaries.items()),
                                 "prediction int, boundary double")


def anomaly_records(outliers: DataFrame, event_type: str = ac.EVENT_TYPE) -> DataFrame:
    """Outliers as table rows. Ports and protocol are synthetic, derived from the id."""
    return (outliers
            .withColumns({
                "timestamp": ac.timestamp_text(),
                "features": ac.vector_text(F.col("features")),
                "type": F.lit(event_type),
                "day": F.col("day").cast("string"),
            })
            .withColumn("id", ac.record_id())
            .withColumns({
                "src_port": ac.synthetic_number(1, ac.PORT_LIMIT),
                "dst_port": ac.synthetic_number(9, ac.PORT_LIMIT),
                "protocol": ac.synthetic_number(17, ac.PROTOCOL_LIMIT),
            })
            .select(*ANOMALY_COLUMNS))


def anomaly_documents(anomalies: DataFrame, digits: int | None = None) -> DataFrame:
    """(id, document): a JSON array of one object per anomaly, every value as text.

    ``digits`` fixes the decimals of the probability.
    """
    probability = (F.col("probability").cast("string") if digits is None
                   else F.format_string(f"%.{digits}f", "probability"))
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ANOMALY_COLUMNS}
    text |= {"anomaly_type": text["type"], "probability": probability}
    fields = F.struct(*[text[c].alias(c) for c in DOCUMENT_FIELDS])
    return anomalies.select("id", F.to_json(F.array(fields)).alias("document"))
