"""Stream flow lines into the connection-feature table, one interval per micro-batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.connections import connection_features
from flowlens.sinks.tables import append_features
from flowlens.sources.lines import netflow_events, rejected_lines
from flowlens.streaming.batches import start_batches


def capture_features(lines: DataFrame, table_path: str, checkpoint: str,
                     segment: Callable[[], str], strict: bool = False,
                     **options) -> StreamingQuery:
    """Summarise every micro-batch as one interval and append it to the feature table.

    ``segment`` gives a batch its label, e.g. from the clock. A batch never ends where an
    event-time bucket does, so buckets by event time are ``capture_windows``' work.
    ``options`` go to ``start_batches``.
    """
    def handle(events: DataFrame, load_id: str) -> None:
        append_features(connection_features(events, segment=segment()), table_path, load_id)

    return start_batches(netflow_events(lines, strict), handle, checkpoint, **options)


def capture_rejected(lines: DataFrame, table_path: str, checkpoint: str,
                     **options) -> StreamingQuery:
    """Append the lines that no event can be read from, with the reason, to a table."""
    def handle(rows: DataFrame, load_id: str) -> None:
        (rows.withColumn("load_id", F.lit(load_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(table_path))

    return start_batches(rejected_lines(lines), handle, checkpoint, **options)
