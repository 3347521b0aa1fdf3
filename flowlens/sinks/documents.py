"""Send anomaly documents to a search index."""

import urllib.request
import uuid
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from flowlens.workspace import exists

Send = Callable[[list[str]], None]
ACKNOWLEDGED = "id string, error string, attempt string"


class DeliveryError(RuntimeError):
    """Some documents were not taken; those that were are in the ledger."""


def send_documents(documents: DataFrame, send: Send, batch_size: int = 500) -> None:
    """Call ``send`` on the executors with up to ``batch_size`` JSON texts at a time.

    A retried task sends its documents again with the same ids, so the receiver must
    replace by id. ``deliver`` keeps a ledger and repeats less.
    """
    def send_partition(rows: Iterator[Row]) -> None:
        texts = (r["document"] for r in rows)
        while batch := list(islice(texts, batch_size)):
            send(batch)

    documents.select("document").foreachPartition(send_partition)


def deliver(documents: DataFrame, send: Send, ledger: str, load_id: str,
            batch_size: int = 500) -> None:
    """Send the documents of a load that the ledger does not hold yet, and enter them.

    ``send`` is called on the executors with up to ``batch_size`` texts; a call that returns
    acknowledges them. When a call fails, its task sends no more, what was acknowledged
    before still goes to the ledger with the job's commit, and a DeliveryError names how
    many are left. Run again with the same load id, it sends those and no others.

    Documents are matched by id. Only the documents of a task that is itself lost, with its
    executor, may be sent twice: the receiver should replace by id all the same. The ledger
    has one folder per load, which ``forget`` removes once the load is done with.
    """
    spark = documents.sparkSession
    folder = f"{ledger.rstrip('/')}/load_id={load_id}"
    todo = documents.select("id", "document")
    if exists(spark, folder):
        sent = spark.read.schema(ACKNOWLEDGED).parquet(folder).where("error IS NULL")
        todo = todo.join(sent.select("id").distinct(), "id", "left_anti")
    attempt = uuid.uuid4().hex

    def send_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        error = None
        for rows in batches:
            for at in range(0, rows.num_rows, batch_size):
                part = rows.slice(at, batch_size)
                if error is None:
                    try:
                        send(part.column("document").to_pylist())
                    except Exception as failure:
                        error = repr(failure)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array([error] * part.num_rows, pa.string())],
                    names=["id", "error"])

    done = todo.mapInArrow(send_partition, "id string, error string")
    done.withColumn("attempt", F.lit(attempt)).write.mode("append").parquet(folder)
    left = (spark.read.schema(ACKNOWLEDGED).parquet(folder)
            .where((F.col("attempt") == attempt) & F.col("error").isNotNull())
            .agg(F.count(F.lit(1)).alias("n"), F.min("error").alias("error")).first())
    if left["n"]:
        raise DeliveryError(f"{left['n']} documents of load {load_id} not sent: {left['error']}")


def http_sender(url: str, timeout: float = 30.0) -> Send:
    """A sender that posts the documents of a batch as one JSON array."""
    def send(batch: list[str]) -> None:
        body = "[" + ",".join(text[1:-1] for text in batch) + "]"
        request = urllib.request.Request(
            url, data=body.encode(), headers={"Content-type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as response:
            response.read()

    return send
