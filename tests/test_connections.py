import pytest
from pyspark.sql import functions as F

from flowlens.operators.connections import connection_features, segment_text
from flowlens.schemas import EXPORTER_SUMS, FEATURES, KEYS, RAW_SCHEMA

BASE = dict(sensor_type="netflow", src_ip="a", dst_ip="b", end_time="2024-03-04 10:07:09",
            src_port=1000, dst_port=80, protocol_name="TCP", netflow_octet_count=10,
            netflow_reverse_octet_count=1, netflow_packet_count=2,
            netflow_reverse_packet_count=3, netflow_flow_end_reason=1)


def events(spark, *changes):
    rows = [{**BASE, **c} for c in changes]
    return spark.createDataFrame(
        [tuple(r.get(n) for n in RAW_SCHEMA.names) for r in rows], RAW_SCHEMA)


def one(table):
    rows = table.collect()
    assert len(rows) == 1
    return rows[0]


def test_columns_and_labels(spark):
    table = connection_features(events(spark, {}))
    assert table.columns == KEYS + FEATURES
    row = one(table)
    assert (str(row.day), row.tsegm_inittime, row.week_day) == ("2024-03-04", "10:05:00", "Mon")


def test_counters(spark):
    row = one(connection_features(events(
        spark,
        {}, {"src_port": 1001, "protocol_name": "UDP", "netflow_flow_end_reason": 6},
        {"src_port": None, "protocol_name": "ICMP", "netflow_flow_end_reason": 5},
        {"src_port": 1001, "dst_port": 53, "protocol_name": "OTHER",
         "netflow_flow_end_reason": None, "netflow_exported_record_count": 7})))
    assert (row.n_events, row.n_src_port, row.n_dst_port) == (4, 2, 2)
    assert (row.n_tcp_protocol, row.n_udp_protocol, row.n_icmp_protocol,
            row.n_unknown_protocol) == (1, 1, 1, 0)
    assert (row.n_octetos, row.n_octetos_reverse, row.n_paquets, row.n_paquets_reverse) \
        == (40, 4, 8, 12)
    assert (row.n_idle_timeout_endreason, row.n_lack_of_resources_endreason) == (1, 1)
    assert (row.n_exported, row.n_dropped) == (7, 0)


def test_all_null_ports_and_sums(spark):
    row = one(connection_features(events(
        spark, {"src_port": None, "dst_port": None, "netflow_octet_count": None})))
    assert (row.n_events, row.n_src_port, row.n_dst_port, row.n_octetos) == (1, 0, 0, 0)


def test_absent_exporter_columns(spark):
    full = events(spark, {"netflow_exported_record_count": 4, "netflow_dropped_packet_count": 2})
    none = one(connection_features(full.drop(*EXPORTER_SUMS.values())))
    assert [none[c] for c in EXPORTER_SUMS] == [0, 0, 0, 0]
    some = one(connection_features(full.drop("netflow_dropped_packet_count")))
    assert (some.n_exported, some.n_dropped) == (4, 0)


def test_null_address_is_a_group(spark):
    rows = connection_features(events(spark, {}, {"src_ip": None}, {"src_ip": None})).collect()
    assert sorted((r.src_ip or "", r.n_events) for r in rows) == [("", 2), ("a", 1)]


def test_unreadable_time_keeps_its_rows(spark):
    rows = connection_features(events(spark, {}, {"end_time": "soon"})).collect()
    assert sorted((str(r.day), r.n_events) for r in rows) == [("2024-03-04", 1), ("None", 1)]


def test_buckets_split_and_segment_joins(spark):
    table = events(spark, {}, {"end_time": "2024-03-04 10:10:00"},
                   {"end_time": "2024-03-05 00:00:01"})
    assert {r.tsegm_inittime for r in connection_features(table).collect()} \
        == {"10:05:00", "10:10:00", "00:00:00"}
    row = one(connection_features(table, segment="23:55:00"))
    assert (str(row.day), row.tsegm_inittime, row.week_day, row.n_events) \
        == ("2024-03-05", "23:55:00", "Tue", 3)


def test_segment_labels(spark):
    labels = spark.range(0, 288).select(segment_text("id", 300).alias("s")).collect()
    assert labels[0].s == "00:00:00" and labels[13].s == "01:05:00" and labels[287].s == "23:55:00"


@pytest.mark.parametrize("seconds", [0, 30, 90, 7 * 60, 2 * 86400])
def test_bad_bucket(spark, seconds):
    with pytest.raises(ValueError):
        connection_features(events(spark, {}), seconds)


def test_hot_pair_equals_plain_distinct(spark):
    """A pair with a third of all rows, against Spark's own distinct counts."""
    raw = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40))
        .alias("src_ip"), F.lit("d").alias("dst_ip"),
        F.lit("2024-03-04 10:00:00").alias("end_time"),
        (F.col("id") * 7919 % 9000).alias("src_port"), (F.col("id") % 17).alias("dst_port"))
    ours = connection_features(raw).select("src_ip", "n_events", "n_src_port", "n_dst_port")
    plain = raw.groupBy("src_ip").agg(
        F.count(F.lit(1)), F.count_distinct("src_port"), F.count_distinct("dst_port"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortAggregate" not in plan
