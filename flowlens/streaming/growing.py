"""Windows as they grow: a corrected row for every window that a micro-batch touches."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from flowlens.operators.connections import SRC_PORT, check_bucket, port_rows, with_raw_columns
from flowlens.schemas import (
    END_REASON_COUNTS, EXPORTER_SUMS, FEATURES, KEYS, PROTOCOL_COUNTS, VOLUME_SUMS,
)
from flowlens.sinks.tables import append_features
from flowlens.sources.loads import current_loads
from flowlens.streaming.batches import start_batches
from flowlens.streaming.windowed import PAIR, event_instant, named_windows, state_settings

#: Counters that are sums; the others are the number of ports of either kind.
SUMS = [c for c in FEATURES if c not in ("n_src_port", "n_dst_port")]
STATE = ", ".join(f"{c} bigint" for c in ("version", *FEATURES))
ROW = ("src_ip string, dst_ip string, start bigint, "
       + ", ".join(f"{c} bigint" for c in FEATURES) + ", version bigint, closed boolean")


class GrowingWindow(StatefulProcessor):
    """Counters of one pair and window, its ports one state row each.

    The ports are entries of a map in the state store, so a busy pair's ports are never one
    value that is read and written whole. A timer at the window's end closes it.
    """

    def __init__(self, bucket_seconds: int):
        self.bucket_ms = bucket_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", STATE)
        self.ports = handle.getMapState("ports", "kind int, port bigint", "seen boolean")

    def row(self, key: tuple, values: tuple, closed: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, *values[1:], values[0], closed)], columns=[
            *PAIR, "start", *FEATURES, "version", "closed"])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame],
                        timerValues) -> Iterator[pd.DataFrame]:
        end = key[2] * 1000 + self.bucket_ms
        if end <= timerValues.getCurrentWatermarkInMs():
            return
        if self.counts.exists():
            values = dict(zip(("version", *FEATURES), self.counts.get()))
        else:
            values = dict.fromkeys(("version", *FEATURES), 0)
            self.handle.registerTimer(end)
        ports = set()
        for part in rows:
            for name, total in part[SUMS].sum().items():
                values[name] += int(total)
            known = part[part["port"].notna()]
            ports.update(zip(known["kind"].astype(int), known["port"].astype("int64")))
        for kind, port in ports:
            place = (int(kind), int(port))
            if not self.ports.containsKey(place):
                self.ports.updateValue(place, (True,))
                values["n_src_port" if kind == SRC_PORT else "n_dst_port"] += 1
        values["version"] += 1
        self.counts.update(tuple(values.values()))
        yield self.row(key, tuple(values.values()), False)

    def handleExpiredTimer(self, key: tuple, timerValues,
                           expiredTimerInfo) -> Iterator[pd.DataFrame]:
        values = self.counts.get()
        self.counts.clear()
        self.ports.clear()
        yield self.row(key, (values[0] + 1, *values[1:]), True)

    def close(self) -> None:
        pass


def summed(rows: DataFrame) -> DataFrame:
    """Rows of one pair, window, kind and port added up, batch by batch in each task.

    A pair with most of the events reaches its state as one row per port and task batch.
    """
    key = [*PAIR, "start", "kind", "port"]

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.groupby(key, dropna=False, as_index=False).agg(
                {"event_time": "max", **dict.fromkeys(SUMS, "sum")})[list(part.columns)]

    return rows.mapInPandas(add, rows.schema)


def growing_features(events: DataFrame, bucket_seconds: int = 300,
                     delay: str = "10 minutes") -> DataFrame:
    """A row (keys, counters, version, closed) for each window whenever it has changed.

    Every micro-batch gives one corrected row for each pair and window that it touches,
    with the counters so far and the next version; when the watermark passes a window's
    end a last row is ``closed``, and its state is removed. Events of closed windows are
    dropped. Use update mode.
    """
    check_bucket(bucket_seconds)
    timed = (with_raw_columns(events).withColumn("event_time", event_instant())
             .where("event_time IS NOT NULL").withWatermark("event_time", delay))
    start = F.unix_timestamp("event_time")
    timed = timed.withColumn("start", start - start % bucket_seconds)
    added = per_event()
    rows = port_rows(timed, "event_time", *PAIR, "start").select(
        "event_time", *PAIR, "start", "kind", "port",
        *[F.coalesce(added[c], F.lit(0)).cast("bigint").alias(c) for c in SUMS])
    grown = summed(rows).groupBy(*PAIR, "start").transformWithStateInPandas(
        GrowingWindow(bucket_seconds), ROW, "Update", "eventTime")
    return named_windows(grown, F.col("start"), bucket_seconds, "version", "closed")


def per_event() -> dict[str, Column]:
    """What a port row adds to the counters that are sums; only an event's first has measures."""
    own = {"n_events": F.when(F.col("kind") == SRC_PORT, 1)}
    own |= {c: F.when(F.col("protocol_name") == v, 1) for c, v in PROTOCOL_COUNTS.items()}
    own |= {c: F.col(name) for c, name in (VOLUME_SUMS | EXPORTER_SUMS).items()}
    return own | {c: F.when(F.col("netflow_flow_end_reason") == v, 1)
                  for c, v in END_REASON_COUNTS.items()}


def capture_growing(events: DataFrame, table_path: str, checkpoint: str,
                    bucket_seconds: int = 300, delay: str = "10 minutes",
                    state_partitions: int | None = None, **options) -> StreamingQuery:
    """Append every corrected row to the day-partitioned table; ``latest_windows`` reads it."""
    spark = events.sparkSession
    with state_settings(spark, state_partitions):
        return start_batches(
            growing_features(events, bucket_seconds, delay),
            lambda rows, load_id: append_features(rows, table_path, load_id),
            checkpoint, stateful=True, mode="update", **options)


def latest_windows(spark: SparkSession, path: str, closed_only: bool = False) -> DataFrame:
    """Keys and counters of every window by its last row, and whether it is closed."""
    table = current_loads(spark.read.parquet(path), path)
    last = Window.partitionBy(*PAIR, "day", "tsegm_inittime").orderBy(F.desc("version"))
    rows = table.withColumn("place", F.row_number().over(last)).where("place = 1")
    rows = rows.where("closed") if closed_only else rows
    return rows.select(*KEYS, *FEATURES, "closed")
