"""Column names and schemas shared by every job."""

from pyspark.sql import types as T

# Names, order and text below must stay as they are, because stored
# tables and models depend on them.

KEYS = ["src_ip", "dst_ip", "day", "tsegm_inittime", "week_day"]

PROTOCOL_COUNTS = {
    "n_tcp_protocol": "TCP",
    "n_udp_protocol": "UDP",
    "n_icmp_protocol": "ICMP",
    "n_unknown_protocol": "UNKNOWN",
}

VOLUME_SUMS = {
    "n_octetos": "netflow_octet_count",
    "n_octetos_reverse": "netflow_reverse_octet_count",
    "n_paquets": "netflow_packet_count",
    "n_paquets_reverse": "netflow_reverse_packet_count",
}

END_REASON_COUNTS = {
    "n_idle_timeout_endreason": 1,
    "n_active_timeout_endreason": 2,
    "n_end_of_flow_detected_endreason": 3,
    "n_forced_end_endreason": 4,
    "n_lack_of_resources_endreason": 5,
}

EXPORTER_SUMS = {
    "n_exported": "netflow_exported_record_count",
    "n_dropped": "netflow_dropped_packet_count",
    "n_ignored": "netflow_ignored_packet_count",
    "n_tcp_urg_count": "netflow_tcp_urg_count",
}

FEATURES = [
    "n_events",
    "n_src_port",
    "n_dst_port",
    *PROTOCOL_COUNTS,
    *VOLUME_SUMS,
    *END_REASON_COUNTS,
    *EXPORTER_SUMS,
]

LABELS = ["anomaly", "anomaly_type", "anomalous_var"]

ANOMALY_COLUMNS = [
    "type", "id", "timestamp", "src_ip", "dst_ip", "src_port", "dst_port",
    "protocol", "prediction", "probability", "day", "features",
]

DOCUMENT_FIELDS = [
    "id", "anomaly_type", "protocol", "features", "probability", "timestamp",
    "src_port", "prediction", "src_ip", "dst_port", "dst_ip", "day",
]

LABELLED_RESULT = [
    "src_ip", "dst_ip", "tsegm_inittime", "week_day", "day", "features", "normalizedFeatures",
    "predictions", "distances", "boundary", "pred_anom", *LABELS,
]

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("sensor_type", "src_ip", "dst_ip", "end_time")]
    + [T.StructField(c, T.LongType()) for c in ("src_port", "dst_port")]
    + [T.StructField("protocol_name", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in VOLUME_SUMS.values()]
    + [T.StructField("netflow_flow_end_reason", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in EXPORTER_SUMS.values()]
)

FEATURE_SCHEMA = T.StructType(
    [T.StructField(c, T.DateType() if c == "day" else T.StringType()) for c in KEYS]
    + [T.StructField(c, T.LongType()) for c in FEATURES]
)

ANOMALY_SCHEMA = T.StructType([
    T.StructField(c, {
        **dict.fromkeys(("src_port", "dst_port", "protocol", "prediction"), T.IntegerType()),
        "probability": T.DoubleType(),
    }.get(c, T.StringType()))
    for c in ANOMALY_COLUMNS
])

LABELLED_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType())
     for c in ("src_ip", "dst_ip", "tsegm_inittime", "week_day", "day")]
    + [T.StructField(c, T.DoubleType()) for c in FEATURES]
    + [T.StructField(c, T.StringType()) for c in LABELS]
)
