"""Connection features as a stateful stream, independent of micro-batch limits."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.connections import (
    SECONDS_PER_DAY, check_bucket, counters, counters_by_port, fill_counters, port_rows,
    segment_text, with_raw_columns,
)
from flowlens.schemas import FEATURES, KEYS
from flowlens.sinks.tables import append_features
from flowlens.streaming.batches import settings, start_batches

PAIR = ["src_ip", "dst_ip"]
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event_instant() -> Column:
    """``end_time`` as an instant, its text read as UTC whatever the session's zone."""
    time = "try_cast(end_time AS TIMESTAMP_NTZ)"
    return F.expr(f"timestamp_seconds(unix_date(to_date({time})) * {SECONDS_PER_DAY}L"
                  f" + hour({time}) * 3600 + minute({time}) * 60 + second({time}))")


def named_windows(grouped: DataFrame, start: Column, bucket_seconds: int,
                  *others: str) -> DataFrame:
    """Keys, counters and others; day and label come from the UTC second a window starts at."""
    named = grouped.withColumn("second", start).withColumns({
        "day": F.expr(f"date_add(DATE'1970-01-01', CAST(second DIV {SECONDS_PER_DAY} AS INT))"),
        "slot": F.expr(f"CAST(second % {SECONDS_PER_DAY} DIV {bucket_seconds} AS INT)"),
    }).withColumns({"tsegm_inittime": segment_text("slot", bucket_seconds),
                    "week_day": F.date_format("day", "E")})
    return fill_counters(named.select(*KEYS, *FEATURES, *others))


def windowed_features(events: DataFrame, bucket_seconds: int = 300,
                      delay: str = "10 minutes") -> DataFrame:
    """One row per (src_ip, dst_ip, window) once the watermark has passed the window.

    The same two aggregates as for stored events. A streaming aggregate cannot count
    distinct values, and holding a port set per pair would keep a busy pair's whole set in
    one state row; here state and work of a busy pair are spread over its ports. Use append
    mode. Events later than ``delay`` behind the newest are dropped; the query's progress
    counts them as ``numRowsDroppedByWatermark``. Rows without a readable time are dropped
    too: ``untimed`` gives them.
    """
    check_bucket(bucket_seconds)
    timed = (with_raw_columns(events).withColumn("event_time", event_instant())
             .where("event_time IS NOT NULL").withWatermark("event_time", delay))
    window = F.window("event_time", f"{bucket_seconds} seconds").alias("window")
    by_port = (port_rows(timed, "event_time", *PAIR)
               .groupBy(window, *PAIR, "kind", "port").agg(*counters_by_port()))
    grouped = by_port.groupBy("window", *PAIR).agg(*counters())
    return named_windows(grouped, F.unix_timestamp("window.start"), bucket_seconds)


def untimed(events: DataFrame) -> DataFrame:
    """Events whose time cannot be read, which no window holds."""
    return events.where("try_cast(end_time AS TIMESTAMP_NTZ) IS NULL")


def start_windows(features: DataFrame, handle: Callable[[DataFrame, str], None],
                  checkpoint: str, state_partitions: int | None = None,
                  **options) -> StreamingQuery:
    """Start a stream of ``windowed_features`` and pass the closed windows to ``handle``.

    ``state_partitions`` is fixed by a checkpoint's first start, so choose it for the load
    to come; a local session may leave it out. State lives in RocksDB on the executors'
    disks, not in their heap, and is saved to the checkpoint.
    """
    with state_settings(features.sparkSession, state_partitions):
        return start_batches(features, handle, checkpoint, stateful=True, **options)


def state_settings(spark: SparkSession, state_partitions: int | None):
    """Session settings for the start of a stateful stream."""
    if state_partitions is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("choose state_partitions; a checkpoint keeps it for good")
        state_partitions = spark.sparkContext.defaultParallelism
    return settings(spark, {"spark.sql.shuffle.partitions": str(state_partitions),
                            "spark.sql.streaming.stateStore.providerClass": STATE_STORE})


def capture_windows(events: DataFrame, table_path: str, checkpoint: str,
                    bucket_seconds: int = 300, delay: str = "10 minutes",
                    state_partitions: int | None = None, **options) -> StreamingQuery:
    """Append every closed window to the day-partitioned table, once and complete."""
    return start_windows(windowed_features(events, bucket_seconds, delay),
                         lambda rows, load_id: append_features(rows, table_path, load_id),
                         checkpoint, state_partitions, **options)


def open_windows(spark: SparkSession, checkpoint: str, bucket_seconds: int = 300) -> DataFrame:
    """Features of the windows that a stopped stream still holds open, so far.

    Read from the checkpoint with Spark's state reader: the first aggregate's state has a
    row per pair, window and port.
    """
    names = [c for c in FEATURES if c not in ("n_src_port", "n_dst_port")]
    buffers = ", ".join(f"{c}: bigint" for c in names)
    operators = (spark.read.format("state-metadata").load(checkpoint)
                 .select("operatorId").distinct().collect())
    for operator in sorted(r["operatorId"] for r in operators):
        state = (spark.read.format("statestore").option("operatorId", operator)
                 .load(checkpoint).select("key", "value"))
        if "port" in state.schema["key"].dataType.names:
            break
    else:
        raise ValueError("the checkpoint holds no windows")
    rows = state.select("key.*", F.col("value").cast(f"struct<{buffers}>").alias("v")).select(
        "window", *PAIR, "kind", "port", "v.*")
    grouped = rows.groupBy("window", *PAIR).agg(*counters())
    return named_windows(grouped, F.unix_timestamp("window.start"), bucket_seconds)
