"""Run a function on every micro-batch of a stream."""

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

INTERVAL = "300 seconds"
#: Held while a stream starts and copies the session's settings, so that no stream picks
#: up values that another one sets for a moment.
STARTING = threading.RLock()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set session values for the start of a stream."""
    with STARTING:
        before = {name: spark.conf.get(name, None) for name in values}
        for name, value in values.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)


def start_batches(stream: DataFrame, handle: Callable[[DataFrame, str], None], checkpoint: str,
                  interval: str = INTERVAL, available_now: bool = False,
                  stateful: bool = False, mode: str = "append") -> StreamingQuery:
    """Call ``handle(rows, load_id)`` for each non-empty batch.

    ``load_id`` names the query and the batch. Spark keeps both in the checkpoint, so a
    batch that is replayed after a failure comes with the id it had before, and another
    stream never shares it.

    A ``stateful`` stream's batch is persisted first, because testing and then writing it
    would run its state updates twice.
    """
    started = threading.Event()
    query_id = []

    def run(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        if stateful:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                handle(batch, f"{query_id[0]}-{batch_id}")
        finally:
            if stateful:
                batch.unpersist()

    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    with STARTING:
        query = (stream.writeStream.foreachBatch(run).outputMode(mode)
                 .option("checkpointLocation", checkpoint).trigger(**trigger).start())
    query_id.append(query.id)
    started.set()
    return query
