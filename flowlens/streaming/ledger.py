"""What a micro-batch has done and met, so that its replay does and meets the same."""

from collections.abc import Callable

from pyspark.sql import SparkSession

from flowlens.workspace import exists, remove


class BatchLedger:
    """Folders below the stream's checkpoint, by load id (``<query>-<batch>``).

    Spark replays the newest batch only, so what belongs to the batch before the last is
    removed when a new one begins.
    """

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark = spark
        self.versions = f"{checkpoint.rstrip('/')}/flowlens/versions"
        self.documents = f"{checkpoint.rstrip('/')}/flowlens/documents"

    def version_of(self, load_id: str, newest: Callable[[], str]) -> str:
        """The detector version of a batch: the newest when it first ran, then that one."""
        folder = f"{self.versions}/load_id={load_id}"
        if exists(self.spark, folder):
            rows = self.spark.read.schema("version string").parquet(folder).collect()
            if rows:
                return rows[0]["version"]
        version = newest()
        self.spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode(
            "overwrite").parquet(folder)
        return version

    def forget_before(self, load_id: str) -> None:
        query, batch = load_id.rsplit("-", 1)
        for folder in (self.versions, self.documents):
            remove(self.spark, f"{folder}/load_id={query}-{int(batch) - 2}")
