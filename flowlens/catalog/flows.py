"""Flow events derived from the ``events`` table, for the registered queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_WORDS = {"S": "string", "fmt": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')"}
DUCKDB_WORDS = {"S": "varchar", "fmt": "strftime(ts, '%Y-%m-%d %H:%M:%S')"}

# Every counter sees all of its cases: other sensors' lines, four protocols, the end
# reasons and an uncounted sixth, missing exporter counters and a constant one.
FLOW_COLUMNS = {
    "sensor_type": "case when event_id % 20 = 19 then 'syslog' else 'netflow' end",
    "src_ip": "concat('10.0.0.', cast(user_id % 50 as {S}))",
    "dst_ip": "concat('192.168.0.', cast(event_id % 4 as {S}))",
    "end_time": "{fmt}",
    "src_port": "1024 + (event_id * 7919) % 64000",
    "dst_port": "cast(case event_type when 'click' then 443 when 'view' then 80"
                " when 'signup' then 53 else 22 end as bigint)",
    "protocol_name": "case event_type when 'view' then 'UDP' when 'error' then 'ICMP'"
                     " when 'signup' then 'UNKNOWN' else 'TCP' end",
    "netflow_octet_count": "cast(round(value * 100) as bigint)",
    "netflow_reverse_octet_count": "cast(round(value * 10) as bigint)",
    "netflow_packet_count": "1 + user_id % 7",
    "netflow_reverse_packet_count": "user_id % 5",
    "netflow_flow_end_reason": "1 + event_id % 6",
    "netflow_exported_record_count": "case when event_id % 10 = 0 then event_id % 13 end",
    "netflow_dropped_packet_count": "case when event_id % 10 = 0 then event_id % 3 end",
    "netflow_ignored_packet_count": "case when event_id % 10 = 0 then cast(0 as bigint) end",
    "netflow_tcp_urg_count": "case when event_type = 'click' then event_id % 2 end",
}


def flow_expressions(words: dict[str, str]) -> list[str]:
    return [f"{text.format(**words)} as {name}" for name, text in FLOW_COLUMNS.items()]


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def all_flows(events: DataFrame) -> DataFrame:
    return events.selectExpr(*flow_expressions(SPARK_WORDS))


def flows_of(events: DataFrame) -> DataFrame:
    return all_flows(events).where(F.col("sensor_type") == "netflow")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows_of(events_table(spark, sf_dir))


def flow_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines; null fields are left out, as real exporters do."""
    return all_flows(events_table(spark, sf_dir)).select(F.to_json(F.struct("*")).alias("value"))


#: Cuts of the input into files, each on the way through a day, so that pairs and days
#: lie on both sides; and the label of each file where a file is an interval.
CUTS = ["2024-01-08 11:17:23", "2024-01-15 16:59:30", "2024-01-22 12:00:00"]
CUT_LABELS = ["00:00:00", "06:00:00", "12:00:00", "18:00:00"]


def line_parts(lines: DataFrame, cuts: list[str]) -> list[DataFrame]:
    """The lines in parts by the time that stands in them."""
    time = F.get_json_object("value", "$.end_time")
    edges = [None, *cuts, None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        part = lines
        if low is not None:
            part = part.where(time >= low)
        parts.append(part if high is None else part.where(time < high))
    return parts


def typed_lines(events: DataFrame) -> DataFrame:
    """Flow lines with numbers as they are, as text, and with a zero fraction, in turn."""
    flows = all_flows(events)
    numbers = [c for c, kind in flows.dtypes if kind == "bigint"]
    lines = None
    for turn, kind in enumerate(("bigint", "string", "decimal(20,1)")):
        own = flows.where(F.col("src_port") % 3 == turn).withColumns(
            {c: F.col(c).cast(kind) for c in numbers})
        part = own.select(F.to_json(F.struct("*")).alias("value"))
        lines = part if lines is None else lines.union(part)
    return lines


#: Lines of which some are no JSON and some have a number that cannot be read.
ODD_LINE = ("""concat('{{"sensor_type":"netflow","src_ip":"10.0.0.', cast(user_id % 50 as {S}),"""
            """ '","src_port":', case event_id % 5 when 0 then '"oops"' when 1 then '80.5'"""
            """ when 2 then '"80"' when 3 then '80.0' else '80' end,"""
            """ case when event_id % 7 = 0 then '' else '}}' end)""")
ODD_REASON = ("case when event_id % 7 = 0 then 'line'"
              " when event_id % 5 in (0, 1) then 'src_port' end")


#: Fields that no schema declares, which some lines have: SQL text of the value, and the type to read it as.
EXTRA_COLUMNS = {
    "exporter_build": "case when event_id % 6 = 0 then cast(event_id % 9 as {S})"
                      " when event_id % 6 = 3 then 'nightly' end",
    "tenant": "case when event_id % 4 < 3 then concat('t', cast(user_id % 5 as {S})) end",
}
EXTRA_FIELDS = {name: "string" for name in EXTRA_COLUMNS}


def drifting_lines(events: DataFrame) -> DataFrame:
    """Flow lines with the extra fields; ``exporter_build`` is a number or a text."""
    extra = [f"{text.format(**SPARK_WORDS)} as {name}" for name, text in EXTRA_COLUMNS.items()]
    rows = events.selectExpr(*flow_expressions(SPARK_WORDS), *extra)
    line = F.to_json(F.struct("*"))
    # A build of digits only stands as a number.
    return rows.select(F.regexp_replace(line, r'"exporter_build":"(\d+)"',
                                        r'"exporter_build":$1').alias("value"))
