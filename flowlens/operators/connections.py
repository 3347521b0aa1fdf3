"""Twenty counters per source/destination address and time bucket."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.schemas import (
    END_REASON_COUNTS, EXPORTER_SUMS, FEATURES, KEYS, PROTOCOL_COUNTS, RAW_SCHEMA, VOLUME_SUMS,
)

SECONDS_PER_DAY = 86400


def check_bucket(bucket_seconds: int) -> None:
    if bucket_seconds < 60 or bucket_seconds % 60 or SECONDS_PER_DAY % bucket_seconds:
        raise ValueError("a bucket must be whole minutes and divide the day")


def with_raw_columns(events: DataFrame) -> DataFrame:
    """Add the fields an event table lacks, as nulls of their type."""
    present = {c.lower() for c in events.columns}
    return events.withColumns({
        f.name: F.lit(None).cast(f.dataType)
        for f in RAW_SCHEMA if f.name not in present
    })


def fill_counters(table: DataFrame) -> DataFrame:
    """Null counters become 0; keys are left alone."""
    return table.na.fill(0, FEATURES)


# The columns that the counters after the distinct counts are made from.
MEASURES = ["protocol_name", *VOLUME_SUMS.values(), "netflow_flow_end_reason",
            *EXPORTER_SUMS.values()]
SRC_PORT, DST_PORT = 1, 2
#: Sketch columns, by the counter that they stand for.
PORT_SKETCHES = {"n_src_port": "src_ports", "n_dst_port": "dst_ports"}
SKETCHES = list(PORT_SKETCHES.values())


def port_rows(events: DataFrame, *keep: str) -> DataFrame:
    """Two rows per event: (kind, port) of either port. Only the first has the measures."""
    ports = (f"array(struct({SRC_PORT} AS kind, CAST(src_port AS BIGINT) AS port),"
             f" struct({DST_PORT} AS kind, CAST(dst_port AS BIGINT) AS port))")
    return events.withColumn("item", F.explode(F.expr(ports))).selectExpr(
        *keep, "item.kind", "item.port",
        *[f"CASE WHEN item.kind = {SRC_PORT} THEN {c} END AS {c}" for c in MEASURES])


def counters_by_port() -> list[Column]:
    """Aggregates of the port rows per (group, kind, port)."""
    return [F.expr(text) for text in [
        "count(1) AS n_events",
        *[f"count(CASE WHEN protocol_name = '{value}' THEN 1 END) AS {name}"
          for name, value in PROTOCOL_COUNTS.items()],
        *[f"sum({column}) AS {name}" for name, column in VOLUME_SUMS.items()],
        *[f"count(CASE WHEN netflow_flow_end_reason = {value} THEN 1 END) AS {name}"
          for name, value in END_REASON_COUNTS.items()],
        *[f"sum({column}) AS {name}" for name, column in EXPORTER_SUMS.items()],
    ]]


def counters() -> list[Column]:
    """Aggregates per group of what ``counters_by_port`` gives: the twenty counters."""
    special = {
        "n_events": f"sum(CASE WHEN kind = {SRC_PORT} THEN n_events END)",
        "n_src_port": f"count(CASE WHEN kind = {SRC_PORT} THEN port END)",
        "n_dst_port": f"count(CASE WHEN kind = {DST_PORT} THEN port END)",
    }
    return [F.expr(f"{special.get(c, f'sum({c})')} AS {c}") for c in FEATURES]


def port_sketches(lg_k: int) -> list[Column]:
    """HyperLogLog sketches of the distinct ports per group, from the rows by port."""
    return [F.hll_sketch_agg(F.when(F.col("kind") == kind, F.col("port")), lg_k).alias(name)
            for kind, name in ((SRC_PORT, "src_ports"), (DST_PORT, "dst_ports"))]


def segment_text(slot: str, bucket_seconds: int) -> Column:
    """Start of the n-th bucket of a day as ``HH:mm:00``."""
    minutes = f"{slot} * {bucket_seconds // 60}"
    return F.expr(f"concat(lpad(CAST({minutes} DIV 60 AS STRING), 2, '0'), ':',"
                  f" lpad(CAST({minutes} % 60 AS STRING), 2, '0'), ':00')")


def connection_features(events: DataFrame, bucket_seconds: int = 300,
                        segment: str | None = None, lg_k: int | None = None) -> DataFrame:
    """One row per (src_ip, dst_ip, bucket): five keys and twenty counters.

    Buckets follow the event time ``end_time``; day and bucket number are group keys, so
    no aggregate over text is needed and both aggregates are hash aggregates. Rows with an
    unreadable time keep a bucket of their own (null day).

    With ``segment`` all events count as one interval with that label: one row per
    address pair, dated by its latest event.

    The distinct port counts are made by grouping twice: by (group, kind, port), then by
    group. A pair that holds most of all events is spread over its ports in the first
    shuffle; in the second it arrives as one combined row per task. Spark's own plan for
    two distinct counts does the same with three rows per event instead of two and every
    aggregate on each of them, and took half as long again.

    With ``lg_k`` two binary columns follow, ``src_ports`` and ``dst_ports``: sketches of
    at most 2 ** lg_k bytes each, which ``rollup`` can add up, as counts of distinct ports
    cannot.
    """
    check_bucket(bucket_seconds)
    sketches = [] if lg_k is None else port_sketches(lg_k)
    events = with_raw_columns(events).withColumn(
        "event_time", F.expr("try_cast(end_time AS TIMESTAMP_NTZ)"))
    pair = ["src_ip", "dst_ip"]
    if segment is None:
        second = "hour(event_time) * 3600 + minute(event_time) * 60 + second(event_time)"
        events = events.withColumns({
            "day": F.to_date("event_time"),
            "slot": F.expr(f"CAST(({second}) DIV {bucket_seconds} AS INT)"),
        })
        group = [*pair, "day", "slot"]
        by_port = (port_rows(events, *group)
                   .groupBy(*group, "kind", "port").agg(*counters_by_port()))
        grouped = by_port.groupBy(*group).agg(*counters(), *sketches)
        label = segment_text("slot", bucket_seconds)
    else:
        by_port = (port_rows(events, *pair, "event_time")
                   .groupBy(*pair, "kind", "port")
                   .agg(F.max("event_time").alias("latest"), *counters_by_port()))
        grouped = by_port.groupBy(*pair).agg(
            F.to_date(F.max("latest")).alias("day"), *counters(), *sketches)
        label = F.lit(segment)
    named = grouped.withColumns({
        "tsegm_inittime": label,
        "week_day": F.date_format("day", "E"),
    })
    extra = [] if lg_k is None else SKETCHES
    return fill_counters(named.select(*KEYS, *FEATURES, *extra))
