import re

import pytest

from flowlens.schemas import FEATURES, LABELS, RAW_SCHEMA
from flowlens.sources.lines import (
    kafka_options, keep_netflow, netflow_events, parse_events, rejected_lines,
)
from flowlens.sources.tables import read_features, read_labelled_csv, rejected_labelled_rows
from flowlens.sources.variants import field_types, field_values, variant_events
from flowlens.sinks.tables import append_features
from flowlens.operators.connections import connection_features
from flowlens.catalog.flows import flows


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_kafka_options():
    options = kafka_options("h1:9092,h2:9092", "a, b,a", max_offsets_per_trigger=10)
    assert options == {"kafka.bootstrap.servers": "h1:9092,h2:9092", "subscribe": "a,b",
                       "startingOffsets": "latest", "maxOffsetsPerTrigger": "10"}
    with pytest.raises(ValueError):
        kafka_options("h:1", " , ")


def test_prefilter_needs_exact_text(spark):
    kept = keep_netflow(lines(spark, '{"sensor_type":"netflow"}', '{"sensor_type": "netflow"}',
                              '{"sensor_type":"syslog"}'))
    assert [r.value for r in kept.collect()] == ['{"sensor_type":"netflow"}']


def test_strict_checks_the_field(spark):
    quoted = r'{"sensor_type":"syslog","note":{"sensor_type":"netflow"},"src_port":1}'
    table = lines(spark, quoted, '{"sensor_type":"netflow","src_port":2}')
    assert netflow_events(table).count() == 2
    assert [r.src_port for r in netflow_events(table, strict=True).collect()] == [2]


def test_parse_absent_fields_and_broken_lines(spark):
    rows = parse_events(lines(spark, '{"src_ip":"a","src_port":5}', '{"src_ip":')).collect()
    assert list(rows[0].asDict()) == RAW_SCHEMA.names
    assert [(r.src_ip, r.src_port, r.end_time) for r in rows] == [("a", 5, None)]


def test_numbers_of_any_form(spark):
    forms = {"80": 80, '"80"': 80, "80.0": 80, '" 80 "': 80, "8e1": 80, "-3": -3, "null": None,
             "9223372036854775807": 2 ** 63 - 1}
    texts = [f'{{"sensor_type":"netflow","src_port":{f}}}' for f in forms]
    assert [r.src_port for r in netflow_events(lines(spark, *texts)).collect()] == list(forms.values())
    bad = ['"x"', "80.5", '""', "true", "99999999999999999999", "[1]"]
    texts = [f'{{"sensor_type":"netflow","src_port":{f}}}' for f in bad]
    assert netflow_events(lines(spark, *texts)).count() == 0
    found = rejected_lines(lines(spark, *texts, '{"sensor_type":"netflow"', "other")).collect()
    assert [r.reason for r in found] == ["src_port"] * len(bad) + ["line"]
    assert [r.value for r in found][:-1] == texts


def parses(table, function):
    return table._jdf.queryExecution().optimizedPlan().toString().count(function)


def test_a_line_is_parsed_once(spark):
    table = lines(spark, '{"sensor_type":"netflow","src_port":5,"tenant":"t"}')
    for found in (netflow_events(table), netflow_events(table, strict=True), rejected_lines(table),
                  netflow_events(table).where("src_port > 3").select("src_ip"),
                  connection_features(netflow_events(table))):
        assert parses(found, "from_json") == 1
    for found in (variant_events(table), variant_events(table, {"tenant": "string"}),
                  variant_events(table).where("src_port > 3"), field_types(table)):
        assert parses(found, "parseJson") == 1


def test_variant_events_equal_parsed_ones(spark, sf_dir):
    from flowlens.catalog.flows import events_table, flow_lines, typed_lines
    for table in (flow_lines(spark, sf_dir), typed_lines(events_table(spark, sf_dir))):
        kept = keep_netflow(table)
        one, other = variant_events(kept), parse_events(kept)
        assert one.dtypes == other.dtypes
        assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0


def test_extra_fields(spark):
    mark = '"sensor_type":"netflow"'
    table = lines(spark, f'{{{mark},"tenant":"t","build":7}}', f'{{{mark},"build":"n"}}',
                  f'{{{mark},"build":{{"a":1}}}}', f'{{{mark},"src_port":"x"}}', f'[{{{mark}}}]',
                  f'{{{mark}')
    found = variant_events(table, {"tenant": "string", "build": "int"}).select("tenant", "build")
    assert [tuple(r) for r in found.collect()] == [("t", 7), (None, None), (None, None)]
    types = {r.field: (r.type, r.n_lines, r.declared) for r in field_types(table).collect()}
    assert types == {"sensor_type": ("STRING", 4, True), "tenant": ("STRING", 1, False),
                     "build": ("VARIANT", 3, False), "src_port": ("STRING", 1, True)}
    values = {(r.field, r.type): r.n_lines for r in field_values(table).collect()}
    assert values["build", "BIGINT"] == values["build", "STRING"] == 1
    assert field_types(table.limit(0)).collect() == []


def test_day_range_prunes_folders(spark, sf_dir, tmp_path):
    path = str(tmp_path / "features")
    append_features(connection_features(flows(spark, sf_dir), 86400), path)
    table = read_features(spark, path, "2024-01-10", "2024-01-11")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*day#", plan)
    assert {str(r.day) for r in table.select("day").distinct().collect()} \
        == {"2024-01-10", "2024-01-11"}


def test_labelled_csv(spark, tmp_path):
    header = ",".join(["src_ip", "dst_ip", "tsegm_initTime", "week_day", "day", *FEATURES,
                       "Anomaly", "AnomalyType", "AnomalousVar"])
    counters = ",".join(['"5"'] + ["1"] * 19)
    file = tmp_path / "labelled.csv"
    file.write_text("\n".join([
        header,
        f"a, b ,10:00:00,Mon,2024-01-01,{counters},true,volume,n_events",
        f"src_ip,b,10:00:00,Mon,2024-01-01,{counters},false,,",
    ]) + "\n")
    rows = read_labelled_csv(spark, str(file)).collect()
    assert [r.src_ip for r in rows] == ["a", "src_ip"]
    assert (rows[0].dst_ip, rows[0].n_events) == ("b", 5.0)
    assert [rows[1][c] for c in LABELS] == ["false", None, None]


@pytest.mark.parametrize("change", [
    lambda r: r.replace(",7,", ",oops,"), lambda r: r.replace(",7,", ",NaN,"),
    lambda r: ",".join(r.split(",")[:3]), lambda r: r + ",more", lambda r: r.replace(",7,", ",,")])
def test_bad_labelled_rows(spark, tmp_path, change):
    header = ",".join(["src_ip", "dst_ip", "tsegm_initTime", "week_day", "day", *FEATURES, *LABELS])
    good = f"a,b,10:00:00,Mon,2024-01-01,7,{','.join(['1'] * 19)},true,volume,n_events"
    file = tmp_path / "labelled.csv"
    file.write_text("\n".join([header, good, change(good)]) + "\n")
    with pytest.raises(Exception, match="unusable row"):
        read_labelled_csv(spark, str(file)).collect()
    assert [r.n_events for r in read_labelled_csv(spark, str(file), "drop").collect()] == [7.0]
    assert rejected_labelled_rows(spark, str(file)).first()["row"].startswith("a,b,")
    with pytest.raises(ValueError):
        read_labelled_csv(spark, str(file), "ignore")
