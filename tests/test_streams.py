import os

import pytest
from pyspark.sql import functions as F

from flowlens.catalog.flows import CUTS, flow_lines, flows, line_parts
from flowlens.catalog.queries import stream_features_windowed, stream_score_windowed
from flowlens.operators.connections import connection_features
from flowlens.operators.detector import Detector
from flowlens.schemas import FEATURES, KEYS, RAW_SCHEMA
from flowlens.sources.lines import file_lines, netflow_events
from flowlens.sources.tables import read_anomalies, read_features
from flowlens.streaming.capture import capture_features, capture_rejected
from flowlens.streaming.growing import capture_growing, latest_windows
from flowlens.streaming.scoring import score_stream, score_windows
from flowlens.streaming.batches import settings
from flowlens.streaming.windowed import capture_windows, open_windows, untimed
from test_detector import PLAIN

LINE = ('{{"sensor_type":"netflow","src_ip":"{src}","dst_ip":"d","end_time":"{time}",'
        '"src_port":{port},"dst_port":80,"protocol_name":"TCP"}}')


def line(src="a", time="2024-03-04 10:01:00", port=1):
    return LINE.format(src=src, time=time, port=port)


def put(folder, name, *texts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def rows(table):
    return sorted(map(tuple, table.collect()), key=repr)


def paths(tmp_path, *names):
    return [str(tmp_path / n) for n in names]


def run(start):
    query = start()
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive
    return query


def test_each_batch_is_an_interval(spark, sf_dir, tmp_path):
    """Four files, one per micro-batch: each equals the batch operator on that file."""
    source, table, checkpoint = paths(tmp_path, "lines", "table", "checkpoint")
    for part in line_parts(flow_lines(spark, sf_dir), CUTS):
        part.coalesce(1).write.mode("append").text(source)
    labels = iter("abcd")
    run(lambda: capture_features(file_lines(spark, source, True, max_files_per_trigger=1), table,
                                 checkpoint, lambda: next(labels), available_now=True))
    parts = line_parts(flow_lines(spark, sf_dir), CUTS)
    expected = [row for label, part in zip("abcd", parts)
                for row in connection_features(netflow_events(part), segment=label).collect()]
    assert rows(read_features(spark, table)) == sorted(map(tuple, expected), key=repr)


def test_restart_reads_only_new_files(spark, tmp_path):
    table, checkpoint = paths(tmp_path, "table", "checkpoint")
    source = tmp_path / "lines"

    def start():
        return capture_features(file_lines(spark, str(source), stream=True), table, checkpoint,
                                lambda: "10:00:00", available_now=True)

    put(source, "1.txt", line(), line(port=2))
    run(start)
    put(source, "2.txt", line("b"), '{"sensor_type":"syslog"}')
    run(start)
    run(start)
    found = read_features(spark, table).select("src_ip", "n_events", "n_src_port")
    assert rows(found) == [("a", 2, 2), ("b", 1, 1)]


def test_new_checkpoint_never_replaces_old_rows(spark, tmp_path):
    table = str(tmp_path / "table")
    source = tmp_path / "lines"
    put(source, "1.txt", line())
    for checkpoint in paths(tmp_path, "c1", "c2"):
        run(lambda: capture_features(file_lines(spark, str(source), stream=True), table,
                                     checkpoint, lambda: "10:00:00", available_now=True))
    assert read_features(spark, table).count() == 2


def test_batch_without_flows_is_skipped(spark, tmp_path):
    calls = []
    source = tmp_path / "lines"
    put(source, "1.txt", '{"sensor_type":"syslog"}')
    run(lambda: capture_features(
        file_lines(spark, str(source), stream=True), *paths(tmp_path, "table", "checkpoint"),
        lambda: calls.append(1) or "10:00:00", available_now=True))
    assert calls == [] and not (tmp_path / "table").exists()


def test_segment_labels_each_batch(spark, tmp_path):
    source = tmp_path / "lines"
    put(source, "1.txt", line(), line(time="2024-03-04 10:59:00"))
    table, checkpoint = paths(tmp_path, "table", "checkpoint")
    run(lambda: capture_features(file_lines(spark, str(source), stream=True), table, checkpoint,
                                 segment=lambda: "11:00:00", available_now=True))
    assert [(r.tsegm_inittime, r.n_events) for r in read_features(spark, table).collect()] \
        == [("11:00:00", 2)]


def test_score_stream_and_model_refresh(spark, tmp_path):
    source = tmp_path / "lines"
    model, table, checkpoint, sent = paths(tmp_path, "model", "table", "checkpoint", "sent")
    zero = [[0.0] * 20]

    def start():
        return score_stream(file_lines(spark, str(source), stream=True), model, table,
                            checkpoint, lambda: "10:00:00", send=send,
                            refresh_each_batch=True, available_now=True)

    def send(batch):
        with open(sent, "a") as out:
            out.writelines(t + "\n" for t in batch)

    Detector(PLAIN, zero, {0: 4.5}).save(spark, model)
    put(source, "1.txt", *[line(port=i) for i in range(5)], line("quiet"))
    run(start)
    found = read_anomalies(spark, table).collect()
    assert [r.src_ip for r in found] == ["a"]
    assert len(open(sent).readlines()) == 1
    Detector(PLAIN, zero, {0: 1e9}).save(spark, model, "overwrite")
    put(source, "2.txt", *[line("c", port=i) for i in range(5)])
    run(start)
    assert read_anomalies(spark, table).count() == 1


@pytest.mark.parametrize("windows", [False, True])
def test_a_replayed_batch_meets_its_own_detector(spark, tmp_path, windows):
    """The sender fails, a new detector is saved, the batch runs again: the old one scores it."""
    source = tmp_path / "lines"
    model, table, checkpoint, sent, flag = paths(
        tmp_path, "model", "table", "checkpoint", "sent", "flag")
    zero = [[0.0] * 20]

    def send(batch):
        with open(sent, "a") as out:
            out.writelines(t + "\n" for t in batch)
        if not os.path.exists(flag):
            open(flag, "w").close()
            raise ConnectionError("stopped")

    def start():
        lines = file_lines(spark, str(source), stream=True)
        common = {"send": send, "refresh_each_batch": True, "available_now": True}
        if windows:
            return score_windows(netflow_events(lines), model, table, checkpoint,
                                 delay="1 minute", **common)
        return score_stream(lines, model, table, checkpoint, lambda: "10:00:00", **common)

    Detector(PLAIN, zero, {0: 4.5}).save(spark, model)
    put(source, "1.txt", *[line(port=i) for i in range(5)], line("quiet"))
    if windows:
        put(source, "2.txt", line("end", "2024-03-04 12:00:00"))
    with pytest.raises(Exception, match="stopped"):
        start().awaitTermination(120)
    Detector(PLAIN, zero, {0: 0.5}).save(spark, model, "overwrite")
    run(start)
    assert [r.src_ip for r in read_anomalies(spark, table).collect()] == ["a"]
    put(source, "3.txt", line("c", "2024-03-04 12:30:00"))
    run(start)
    put(source, "4.txt", line("end2", "2024-03-04 15:00:00"))
    run(start)
    found = [r.src_ip for r in read_anomalies(spark, table).collect()]
    assert "c" in found and "quiet" not in found
    kept = [p.name for p in (tmp_path / "checkpoint/flowlens/versions").glob("load_id=*")]
    assert len(kept) <= 2


def test_refresh_needs_a_path(spark, tmp_path):
    with pytest.raises(ValueError):
        score_stream(spark.readStream.text(str(tmp_path)), Detector(PLAIN, [[0.0] * 20], {}),
                     "t", "c", lambda: "10:00:00", refresh_each_batch=True)


def windowed(spark, source, table, checkpoint, **options):
    events = netflow_events(file_lines(spark, str(source), stream=True, **options))
    run(lambda: capture_windows(events, table, checkpoint, delay="20 minutes",
                                available_now=True))


def test_windows_join_events_of_several_batches(spark, tmp_path):
    source = tmp_path / "lines"
    table, checkpoint = paths(tmp_path, "table", "checkpoint")
    put(source, "1.txt", line(port=1), line(port=1), line(time="2024-03-04 10:06:00"))
    windowed(spark, source, table, checkpoint)
    put(source, "2.txt", line(port=2), line(time="2024-03-04 10:12:00", port=3))
    windowed(spark, source, table, checkpoint)
    put(source, "3.txt", line("end", time="2024-03-04 12:00:00"))
    windowed(spark, source, table, checkpoint)
    whole = spark.read.text(str(source))
    batch = connection_features(netflow_events(whole)).where("src_ip != 'end'")
    stream = read_features(spark, table)
    assert stream.columns == KEYS + FEATURES
    assert rows(stream) == rows(batch) and stream.count() == 3


def test_windowed_counts_equal_batch_for_busy_pair(spark, tmp_path):
    source = tmp_path / "lines"
    texts = [line("busy" if i % 3 == 0 else f"s{i % 9}", port=i * 31 % 500) for i in range(900)]
    for part in range(3):
        put(source, f"{part}.txt", *texts[part::3])
    put(source, "9.txt", line("end", time="2024-03-04 12:00:00"))
    table, checkpoint = paths(tmp_path, "table", "checkpoint")
    windowed(spark, source, table, checkpoint)
    batch = connection_features(netflow_events(spark.read.text(str(source))))
    assert rows(read_features(spark, table)) == rows(batch.where("src_ip != 'end'"))


def test_growing_windows_are_corrected_and_closed(spark, tmp_path):
    """Versions count up; last rows equal the batch, closed ones the closed windows."""
    source = tmp_path / "lines"
    grown, table, c1, c2 = paths(tmp_path, "grown", "table", "c1", "c2")

    def take(*names_and_lines):
        put(source, *names_and_lines)
        lines = file_lines(spark, str(source), stream=True)
        run(lambda: capture_growing(netflow_events(lines), grown, c1, delay="20 minutes",
                                    available_now=True))
        windowed(spark, source, table, c2)

    take("1.txt", line(port=1), line(port=1), line(time="2024-03-04 10:06:00"))
    take("2.txt", line(port=2), line("b", port=5), line(time="2024-03-04 10:12:00", port=3))
    take("3.txt", line("end", time="2024-03-04 12:00:00"))
    take("4.txt", line(port=9), line("end", time="2024-03-04 12:01:00", port=4))
    whole = connection_features(netflow_events(spark.read.text(str(source)).where(
        "value not like '%\"src_port\":9%'")))
    assert rows(latest_windows(spark, grown).drop("closed")) == rows(whole)
    closed = latest_windows(spark, grown, closed_only=True).drop("closed")
    assert rows(closed) == rows(read_features(spark, table)) and closed.count() == 4
    versions = spark.read.parquet(grown).where("src_ip = 'a' and tsegm_inittime = '10:00:00'")
    assert sorted((r.version, r.n_events, r.n_src_port, r.closed) for r in versions.collect()) == [
        (1, 2, 1, False), (2, 3, 2, False), (3, 3, 2, True)]


def test_raw_schema_names_are_lower_case():
    assert RAW_SCHEMA.names == [n.lower() for n in RAW_SCHEMA.names]


@pytest.mark.parametrize("query", [stream_features_windowed, stream_score_windowed])
def test_windows_do_not_depend_on_the_files(spark, sf_dir, query):
    other = ["2024-01-03 01:02:03", "2024-01-08 23:00:00", "2024-01-09 00:30:00",
             "2024-01-17 05:05:05", "2024-01-28 20:00:00"]
    first = rows(query(spark, sf_dir))
    assert first and first == rows(query(spark, sf_dir, other)) == rows(query(spark, sf_dir, []))


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kathmandu"])
@pytest.mark.parametrize("bucket", [300, 3600, 86400])
def test_windows_equal_batch_in_any_zone(spark, tmp_path, zone, bucket):
    source, table, checkpoint = paths(tmp_path, "lines", "table", "checkpoint")
    times = ["2024-03-09 23:59:59", "2024-03-10 00:00:00", "2024-03-10 02:30:00",
             "2024-03-10 07:02:03", "2024-03-31 01:30:00", "2024-11-03 01:30:00"]
    put(tmp_path / "lines", "1.txt", *[line(f"s{i}", t) for i, t in enumerate(times)])
    put(tmp_path / "lines", "2.txt", line("end", "2024-12-31 00:00:00"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        events = netflow_events(file_lines(spark, source, stream=True))
        run(lambda: capture_windows(events, table, checkpoint, bucket, available_now=True))
        batch = connection_features(netflow_events(spark.read.text(source)), bucket)
        found = rows(read_features(spark, table))
        assert found == rows(batch.where("src_ip != 'end'")) and len(found) == len(times)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_open_windows(spark, tmp_path):
    source = tmp_path / "lines"
    table, checkpoint = paths(tmp_path, "table", "checkpoint")
    put(source, "1.txt", *[line(port=i % 3) for i in range(7)],
        line("b", "2024-03-04 10:06:00"), line("old", "2024-03-04 08:00:00"))
    windowed(spark, source, table, checkpoint)
    whole = rows(connection_features(netflow_events(spark.read.text(str(source)))))
    held = rows(open_windows(spark, checkpoint))
    assert len(held) == 2 and sorted(held + rows(read_features(spark, table)), key=repr) == whole


def test_rejected_lines_are_stored_once(spark, tmp_path):
    source = tmp_path / "lines"
    table, checkpoint = paths(tmp_path, "rejected", "checkpoint")
    put(source, "1.txt", line(), line()[:-1], line(port='"x"'))
    for _ in range(2):
        run(lambda: capture_rejected(file_lines(spark, str(source), stream=True), table,
                                     checkpoint, available_now=True))
    assert rows(spark.read.parquet(table).select("reason")) == [("line",), ("src_port",)]


def test_untimed(spark, tmp_path):
    table = spark.createDataFrame([(line(time="soon"),), (line(),)], "value string")
    assert untimed(netflow_events(table)).count() == 1


def test_settings_come_back(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with settings(spark, {name: "3", "flowlens.test": "x"}):
        assert spark.conf.get(name) == "3"
    assert spark.conf.get(name) == before and spark.conf.get("flowlens.test", None) is None
