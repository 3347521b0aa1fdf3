"""DuckDB SQL for the registered queries, over the same tables."""

from flowlens.catalog.flows import (
    CUT_LABELS, CUTS, DUCKDB_WORDS, EXTRA_COLUMNS, ODD_LINE, ODD_REASON, flow_expressions,
)
from flowlens.catalog.queries import (
    FIRST_DAY, FIT_K, K, LAST_DAY, LINE_KEYS, PERCENTILE, SCORE_FIRST_DAY, SEGMENT, STEPS, SWEEP_KS,
    SWEEP_STEPS, TRAIN_LAST_DAY,
)
from flowlens.functions.anomaly_columns import EVENT_TYPE, PORT_LIMIT, PROTOCOL_LIMIT
from flowlens.schemas import (
    DOCUMENT_FIELDS, END_REASON_COUNTS, EXPORTER_SUMS, FEATURES, KEYS, PROTOCOL_COUNTS, RAW_SCHEMA,
    VOLUME_SUMS,
)

KEY_LIST = ", ".join(KEYS)
FEATURE_LIST = ", ".join(FEATURES)
DAY, FIVE_MINUTES = "1 day", "5 minutes"
SHARE = PERCENTILE / 100
# DuckDB rounds a small negative number to -0.0, Spark to 0.0; adding 0 leaves one zero.
SIGNED = "round({v}, 6) + 0"


def with_steps(steps: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{name} AS MATERIALIZED ({text})" for name, text in steps)
    return f"WITH {body}\n{final}"


ALL_FLOWS = ("all_flows", f"SELECT {', '.join(flow_expressions(DUCKDB_WORDS))} FROM events")
FLOWS = ("flows", "SELECT * FROM all_flows WHERE sensor_type = 'netflow'")


def counters(exporter_stats: bool = True) -> str:
    parts = ["count(*) AS n_events", "count(DISTINCT src_port) AS n_src_port",
             "count(DISTINCT dst_port) AS n_dst_port"]
    parts += [f"count(*) FILTER (protocol_name = '{v}') AS {n}"
              for n, v in PROTOCOL_COUNTS.items()]
    parts += [f"coalesce(sum({c}), 0)::BIGINT AS {n}" for n, c in VOLUME_SUMS.items()]
    parts += [f"count(*) FILTER (netflow_flow_end_reason = {v}) AS {n}"
              for n, v in END_REASON_COUNTS.items()]
    parts += [(f"coalesce(sum({c}), 0)" if exporter_stats else "0") + f"::BIGINT AS {n}"
              for n, c in EXPORTER_SUMS.items()]
    return ", ".join(parts)


def features(bucket: str, exporter_stats: bool = True, having: str = "") -> tuple[str, str]:
    start = f"time_bucket(INTERVAL '{bucket}', end_time::TIMESTAMP)"
    return ("features", f"""
        SELECT src_ip, dst_ip, {start}::DATE AS day,
               strftime({start}, '%H:%M:00') AS tsegm_inittime,
               strftime({start}, '%a') AS week_day, {counters(exporter_stats)}
        FROM flows GROUP BY src_ip, dst_ip, {start} {having}""")


def feature_query(bucket: str, where: str = "", **options) -> str:
    return with_steps([ALL_FLOWS, FLOWS, features(bucket, **options)],
                      f"SELECT {KEY_LIST}, {FEATURE_LIST} FROM features {where}")


# Model steps. ``train`` names the table the scaler and centres come from, ``rows`` the
# table that is scored.

def scaling(train: str, rows: str) -> list[tuple[str, str]]:
    stats = ", ".join(f"avg({c}) AS m_{c}, coalesce(stddev_samp({c}), 0) AS s_{c}"
                      for c in FEATURES)
    z = ", ".join(f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END"
                  for c in FEATURES)
    f = ", ".join(f"{c}::DOUBLE" for c in FEATURES)
    steps = [("stats", f"SELECT {stats} FROM {train}")]
    for name, source in dict([("train_z", train), ("rows_z", rows)]).items():
        steps.append((name, f"""
            SELECT row_number() OVER (ORDER BY src_ip, dst_ip, day, tsegm_inittime) AS row_id,
                   {KEY_LIST}, [{f}]::DOUBLE[] AS fv, [{z}]::DOUBLE[] AS zv
            FROM {source}, stats"""))
    return steps


def nearest(name: str, rows: str, centers: str) -> tuple[str, str]:
    return (name, f"""
        SELECT row_id, min(struct_pack(d := list_distance(zv, c), p := p)) AS best
        FROM {rows}, {centers} GROUP BY row_id""")


def pinned(k: int, steps: int, tag: str = "") -> list[tuple[str, str]]:
    """Centres ``c{tag}_{steps}`` from the first k rows of ``train_z``."""
    means = ", ".join(f"avg(zv[{i + 1}])" for i in range(len(FEATURES)))
    out = [(f"c{tag}_0",
            f"SELECT (row_id - 1)::INTEGER AS p, zv AS c FROM train_z WHERE row_id <= {k}")]
    for i in range(steps):
        old, near, new = f"c{tag}_{i}", f"a{tag}_{i}", f"c{tag}_{i + 1}"
        out.append(nearest(near, "train_z", old))
        out.append((new, f"""
            SELECT {old}.p, coalesce(m.c, {old}.c) AS c FROM {old} LEFT JOIN (
                SELECT best.p AS p, [{means}]::DOUBLE[] AS c
                FROM train_z JOIN {near} USING (row_id) GROUP BY best.p) m ON m.p = {old}.p"""))
    return out


CENTERS = f"c_{STEPS}"


def scored(name: str, rows: str) -> list[tuple[str, str]]:
    return [nearest(f"{name}_near", rows, CENTERS),
            (name, f"""
                SELECT {rows}.*, best.p AS prediction, best.d AS distance
                FROM {rows} JOIN {name}_near USING (row_id)""")]


BOUNDARIES = ("boundaries", f"""
    SELECT prediction, quantile_cont(distance, {SHARE}) AS boundary
    FROM train_scored GROUP BY prediction""")

RECORDS = [
    ("outliers", """
        SELECT s.*, boundary, 1 - boundary / distance AS probability
        FROM rows_scored s JOIN boundaries USING (prediction) WHERE distance > boundary"""),
    ("texts", f"""
        SELECT *, day::VARCHAR || ' ' || tsegm_inittime AS "timestamp",
               '[' || array_to_string(fv, ',') || ']' AS feature_text,
               md5(concat_ws('|', src_ip, dst_ip, day::VARCHAR || ' ' || tsegm_inittime,
                   prediction, '[' || array_to_string(fv, ',') || ']')) AS id
        FROM outliers"""),
    ("records", f"""
        SELECT '{EVENT_TYPE}' AS type, id, "timestamp", src_ip, dst_ip,
               (('0x' || substr(id, 1, 8))::BIGINT % {PORT_LIMIT})::INTEGER AS src_port,
               (('0x' || substr(id, 9, 8))::BIGINT % {PORT_LIMIT})::INTEGER AS dst_port,
               (('0x' || substr(id, 17, 8))::BIGINT % {PROTOCOL_LIMIT})::INTEGER AS protocol,
               prediction::INTEGER AS prediction, probability, day::VARCHAR AS day,
               feature_text AS features
        FROM texts"""),
]


def model(final: str, bucket: str = DAY, train_where: str = "", rows_where: str = "",
          steps: list[tuple[str, str]] = (), rows: str = "SELECT * FROM features") -> str:
    """Features, pinned training on them, and scoring of ``rows``."""
    return with_steps([
        ALL_FLOWS, FLOWS, features(bucket),
        ("train", f"SELECT * FROM features {train_where}"),
        ("rows_", f"{rows} {rows_where}"),
        *scaling("train", "rows_"), *pinned(K, STEPS),
        *scored("train_scored", "train_z"), *scored("rows_scored", "rows_z"),
        BOUNDARIES, *steps], final)


def records(rows_where: str = "", train_where: str = "", **options) -> str:
    return model("SELECT * REPLACE (round(probability, 4) AS probability) FROM records",
                 train_where=train_where, rows_where=rows_where, steps=RECORDS, **options)


def sweep_steps(ks: range, steps: int) -> list[tuple[str, str]]:
    """Pinned centres of all counts together; ``w{steps}`` and their rows ``v{steps}``."""
    means = ", ".join(f"avg(zv[{i + 1}])" for i in range(len(FEATURES)))
    out = [("w0", f"""SELECT k, (row_id - 1)::INTEGER AS p, zv AS c
                      FROM train_z, range({ks.start}, {ks.stop}) r(k) WHERE row_id <= k""")]
    for i in range(steps + 1):
        out.append((f"v{i}", f"""
            SELECT k, row_id, min(struct_pack(d := list_distance(zv, c), p := p)) AS best
            FROM train_z, w{i} GROUP BY k, row_id"""))
        if i < steps:
            out.append((f"w{i + 1}", f"""
                SELECT k, p, coalesce(m.c, w{i}.c) AS c FROM w{i} LEFT JOIN (
                    SELECT k, best.p AS p, [{means}]::DOUBLE[] AS c
                    FROM train_z JOIN v{i} USING (row_id) GROUP BY k, best.p) m USING (k, p)"""))
    return out


def pinned_sweep(final: str) -> str:
    return with_steps([ALL_FLOWS, FLOWS, features(DAY), *scaling("features", "features"),
                       *sweep_steps(SWEEP_KS, SWEEP_STEPS)], final.format(n=SWEEP_STEPS))


SWEEP_POINTS = pinned_sweep("""
    SELECT k::INTEGER AS k, round(sum(best.d * best.d), 4) AS cost FROM v{n} GROUP BY k""")
SWEEP_CENTERS = pinned_sweep("""
    SELECT k::INTEGER AS k, p AS prediction, count(row_id) AS n_rows,
           round(coalesce(sum(v.best.d * v.best.d), 0), 4) AS cost
    FROM w{n} w LEFT JOIN (SELECT *, best.p AS p FROM v{n}) v USING (k, p) GROUP BY k, p""")


def scaler_stats(where: str = "") -> str:
    rows = " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS idx, '{c}' AS feature, round(m_{c}, 6) AS mean,"
        f" round(s_{c}, 6) AS std FROM stats" for i, c in enumerate(FEATURES))
    return with_steps([ALL_FLOWS, FLOWS, features(DAY), ("chosen", f"SELECT * FROM features {where}"),
                       *scaling("chosen", "chosen")], rows)


def exploded(vector: str, source: str, value: str, key: str = KEY_LIST) -> str:
    return f"""SELECT {key}, (i - 1)::INTEGER AS idx, {value.format(v=f'{vector}[i]')} AS value
               FROM {source}, range(1, {len(FEATURES) + 1}) r(i)"""


def artifacts() -> str:
    rows = [f"SELECT '{part}' AS part, 0 AS id, {i}::INTEGER AS idx, round({p}_{c}, 6) AS value"
            f" FROM stats" for part, p in (("mean", "m"), ("std", "s"))
            for i, c in enumerate(FEATURES)]
    rows.append(exploded("c", CENTERS, SIGNED, "'center' AS part, p::INTEGER AS id"))
    rows.append("SELECT 'boundary', prediction::INTEGER, 0, round(boundary, 6) FROM boundaries")
    return model(" UNION ALL ".join(rows))


ODD = "n_octetos > 20000"
LABEL_COLUMNS = f"""({ODD})::VARCHAR AS anomaly, CASE WHEN {ODD} THEN 'volume' END AS anomaly_type,
    CASE WHEN {ODD} THEN 'n_octetos' END AS anomalous_var"""
TEXT_KEYS = "src_ip, dst_ip, tsegm_inittime, week_day, day::VARCHAR AS day"

CLOSED_DAYS = """WHERE day + INTERVAL '1 day'
    <= (SELECT max(end_time::TIMESTAMP) - INTERVAL '10 minutes' FROM flows)"""

DISTANCES = f"""SELECT {KEY_LIST}, prediction::INTEGER AS predictions,
    round(distance, 6) AS distances, (i - 1)::INTEGER AS idx, fv[i] AS value,
    {SIGNED.format(v="zv[i]")} AS normalized
    FROM train_scored, range(1, {len(FEATURES) + 1}) r(i)"""

def intervals(label: str) -> str:
    """One row per pair and label."""
    return f"""SELECT src_ip, dst_ip, max(end_time::TIMESTAMP)::DATE AS day,
        label AS tsegm_inittime, strftime(max(end_time::TIMESTAMP), '%a') AS week_day,
        {counters()} FROM (SELECT *, {label} AS label FROM flows) GROUP BY src_ip, dst_ip, label"""


BATCH = intervals(f"'{SEGMENT}'")
FILES = intervals("CASE " + " ".join(
    f"WHEN end_time < '{cut}' THEN '{label}'" for cut, label in zip(CUTS, CUT_LABELS))
    + f" ELSE '{CUT_LABELS[-1]}' END")

# Values holds text without characters that JSON escapes, so plain concatenation is enough.
DOCUMENT = " || ',' || ".join(
    f"'\"{f}\":\"' || {'type' if f == 'anomaly_type' else f}_text || '\"'"
    for f in DOCUMENT_FIELDS)
DOCUMENT_TEXTS = ", ".join(
    ("printf('%.4f', probability)" if f == "probability"
     else f'"{"type" if f == "anomaly_type" else f}"::VARCHAR')
    + f" AS {'type' if f == 'anomaly_type' else f}_text" for f in DOCUMENT_FIELDS)

BOUNDARY_ROWS = "SELECT prediction::INTEGER AS prediction, round(boundary, 6) AS boundary" \
                " FROM boundaries"
BETWEEN = f"WHERE day BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"
PARSED = f"SELECT {', '.join(RAW_SCHEMA.names)} FROM flows"

LABELLED = model(f"""
        SELECT {TEXT_KEYS}, '[' || array_to_string(fv, ',') || ']' AS features,
               prediction::INTEGER AS predictions, round(distance, 6) AS distances,
               round(boundary, 6) AS boundary, distance > boundary AS pred_anom,
               {LABEL_COLUMNS.replace("n_octetos >", f"fv[{FEATURES.index('n_octetos') + 1}] >")}
        FROM rows_scored JOIN boundaries USING (prediction)""")

def field_rows(kind: str, extra: bool) -> list[str]:
    """A SELECT of (field, type) of the lines that have the field, for every field."""
    columns = {c: ("STRING" if c in TEXT_FIELDS else kind) for c in RAW_SCHEMA.names}
    rows = [f"SELECT '{c}' AS field, {k if k != 'STRING' else repr(k)} AS type, TRUE AS declared"
            f" FROM flows WHERE {c} IS NOT NULL" for c, k in columns.items()]
    if extra:
        rows += [f"SELECT '{c}', {'VARIANT' if c == 'exporter_build' else 'STRING'!r}, FALSE"
                 f" FROM events WHERE event_id % 20 <> 19 AND ({text.format(**DUCKDB_WORDS)})"
                 " IS NOT NULL" for c, text in EXTRA_COLUMNS.items()]
    return rows


TEXT_FIELDS = [f.name for f in RAW_SCHEMA if f.dataType.simpleString() == "string"]
#: Numbers of lines whose port leaves 0, 1, 2 by three: as they are, as text, with a fraction.
MIXED = "['BIGINT', 'STRING', 'DECIMAL'][src_port % 3 + 1]"


def field_counts(kind: str, extra: bool) -> str:
    return with_steps([ALL_FLOWS, FLOWS], f"""SELECT field, type, count(*) AS n_lines, declared
        FROM ({" UNION ALL ".join(field_rows(kind, extra))}) GROUP BY field, type, declared""")


EXTRA_EVENTS = with_steps(
    [("drifting", f"SELECT {', '.join(flow_expressions(DUCKDB_WORDS))}, "
      + ", ".join(f"{text.format(**DUCKDB_WORDS)} AS {name}" for name, text in EXTRA_COLUMNS.items())
      + " FROM events")],
    f"""SELECT {', '.join([*RAW_SCHEMA.names, *EXTRA_COLUMNS])}
        FROM drifting WHERE sensor_type = 'netflow'""")

SUMMED = [c for c in FEATURES if c not in ("n_src_port", "n_dst_port")]
NEAR = "n_src_port, n_dst_port, TRUE AS n_src_port_near, TRUE AS n_dst_port_near"

REFRESHED = model(f"""
    SELECT prediction::INTEGER AS prediction, count(*) AS n_rows, TRUE AS all_rows, TRUE AS rank_near
    FROM train_scored {BETWEEN} GROUP BY prediction""")


ORACLES: dict[str, str] = {
    "connection_rollup": with_steps(
        [ALL_FLOWS, FLOWS, features(DAY)],
        f"SELECT {KEY_LIST}, {', '.join(SUMMED)}, {NEAR} FROM features"),
    "address_rollup": with_steps([ALL_FLOWS, FLOWS], f"""
        SELECT src_ip, {', '.join(SUMMED)}, {NEAR}
        FROM (SELECT src_ip, {counters()} FROM flows GROUP BY src_ip)"""),
    "boundaries_refreshed": REFRESHED,
    "scaler_from_moments": scaler_stats(BETWEEN),
    "flow_json_schema": field_counts("'BIGINT'", True),
    "flow_json_mixed_types": field_counts(MIXED, False),
    "flow_json_extra": EXTRA_EVENTS,
    "connection_features": feature_query(FIVE_MINUTES),
    "connection_features_batch": with_steps([ALL_FLOWS, FLOWS], BATCH),
    "connection_features_no_stats": feature_query(FIVE_MINUTES, exporter_stats=False),
    "na_fill_zero": feature_query(DAY),
    "netflow_prefilter": with_steps(
        [ALL_FLOWS, FLOWS],
        f"SELECT {', '.join(f'{c}::VARCHAR AS {c}' for c in LINE_KEYS)} FROM flows"),
    "flow_json_parse": with_steps([ALL_FLOWS, FLOWS], PARSED),
    "flow_json_typed": with_steps([ALL_FLOWS, FLOWS], PARSED),
    "flow_json_rejected": f"""
        SELECT * FROM (SELECT {ODD_LINE.format(**DUCKDB_WORDS)} AS value, {ODD_REASON} AS reason
                       FROM events) WHERE reason IS NOT NULL""",
    "history_day_range": feature_query(DAY, BETWEEN),
    "partitioned_table_roundtrip": feature_query(DAY),
    "compacted_table_roundtrip": feature_query(DAY),
    "training_set_roundtrip": feature_query(DAY),
    "feature_vector": model(exploded("fv", "train_z", "{v}")),
    "scaler_stats": scaler_stats(),
    "standardized_features": model(exploded("zv", "train_z", SIGNED)),
    "cluster_fit_pinned": model(
        exploded("c", CENTERS, SIGNED, "p::INTEGER AS prediction")),
    "nearest_center": model(
        f"SELECT {KEY_LIST}, prediction::INTEGER AS prediction FROM train_scored"),
    "center_distance": model(f"SELECT {KEY_LIST}, round(distance, 6) AS distance"
                             " FROM train_scored"),
    "clustering_cost": model("SELECT round(sum(distance * distance), 4) AS cost"
                             " FROM train_scored"),
    "elbow_curve_pinned": SWEEP_POINTS,
    "elbow_shared_scan": SWEEP_CENTERS,
    "cluster_fit": model(f"""
        SELECT {FIT_K} AS k, count(*) AS n_rows,
               round(sum(list_inner_product(zv, zv)), 3) AS total_squares, TRUE AS all_nearest,
               TRUE AS cost_below_total, TRUE AS cost_at_most_training FROM train_z"""),
    "train_then_score": with_steps(
        [ALL_FLOWS, FLOWS, features(DAY)],
        f"SELECT {FIT_K} AS k, count(*) AS n_rows, TRUE AS ranks_hold FROM features"),
    "detector_from_model": with_steps(
        [ALL_FLOWS, FLOWS, features(DAY)],
        f"SELECT count(*) AS n_rows, {K} AS k, TRUE AS same FROM features"),
    "elbow_curve": with_steps([ALL_FLOWS, FLOWS, features(DAY)], """
        SELECT k::INTEGER AS k, n_rows, TRUE AS below_one, TRUE AS cost_holds
        FROM (SELECT count(*) AS n_rows FROM features), range(2, 61) r(k)"""),
    "elbow_points_roundtrip": SWEEP_POINTS,
    "cluster_boundaries": model(BOUNDARY_ROWS),
    "cluster_boundaries_narrowed": model(BOUNDARY_ROWS),
    "cluster_boundaries_approx": model(f"""
        SELECT prediction::INTEGER AS prediction,
               round(quantile_disc(distance, {SHARE}), 6) AS boundary
        FROM train_scored GROUP BY prediction"""),
    "distances_table": model(DISTANCES),
    "anomaly_filter": model(f"""
        SELECT {KEY_LIST}, prediction::INTEGER AS prediction, round(distance, 6) AS distance,
               round(boundary, 6) AS boundary FROM outliers""", steps=RECORDS[:1]),
    "anomaly_flags": model(f"""
        SELECT {KEY_LIST}, prediction::INTEGER AS prediction, distance > boundary AS pred_anom
        FROM rows_scored JOIN boundaries USING (prediction)"""),
    "anomaly_probability": model(
        f"SELECT {KEY_LIST}, round(probability, 4) AS probability FROM outliers",
        steps=RECORDS[:1]),
    "anomaly_records": records(),
    "anomaly_documents": model(
        f"SELECT id, '[{{' || {DOCUMENT} || '}}]' AS document"
        f" FROM (SELECT id, {DOCUMENT_TEXTS} FROM records)", steps=RECORDS),
    "anomaly_table_roundtrip": records(),
    "artifact_roundtrip": artifacts(),
    "train_then_score_pinned": records(f"WHERE day >= DATE '{SCORE_FIRST_DAY}'",
                                       f"WHERE day <= DATE '{TRAIN_LAST_DAY}'"),
    "history_anomalies": records(BETWEEN),
    "labelled_csv_parse": with_steps(
        [ALL_FLOWS, FLOWS, features(DAY)],
        f"SELECT {TEXT_KEYS}, {', '.join(f'{c}::DOUBLE AS {c}' for c in FEATURES)},"
        f" {LABEL_COLUMNS} FROM features"),
    "labelled_csv_rejected": with_steps(
        [ALL_FLOWS, FLOWS, features(DAY)],
        f"SELECT {TEXT_KEYS} FROM features WHERE n_paquets % 3 < 2"),
    "labelled_scoring": LABELLED,
    "labelled_result_roundtrip": LABELLED,
    "stream_features_available_now": with_steps([ALL_FLOWS, FLOWS], FILES),
    "stream_features_windowed": feature_query(DAY, CLOSED_DAYS),
    "stream_windows_growing": feature_query(DAY),
    "stream_score_available_now": records(rows=FILES),
    "stream_score_windowed": records(CLOSED_DAYS),
}
