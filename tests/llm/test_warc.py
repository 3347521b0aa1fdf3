import hashlib
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowlens.llm.warc import read_archive, write_archive

PAGES = "page_id bigint, url string, html string"


def expected_rows(pages):
    best = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 1000:
            best[data] = max(best.get(data, -1), page_id)
    rows = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        first = best.get(data, page_id)
        rows[page_id] = (len(data), hashlib.sha1(data).hexdigest(),
                         "response" if first == page_id else "revisit",
                         None if first == page_id else first)
    return rows


def digest_columns(rows):
    return {r.page_id: (len(r.payload), hashlib.sha1(r.payload).hexdigest(), r.record_type,
                        r.refers_to) for r in rows}


def test_query_equals_brute_force(spark, sf_dir, pages):
    found = entry.queries()["op4_warc"](spark, sf_dir).collect()
    assert len(found) == pages.count()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
            for r in found} == expected_rows(pages.collect())


@pytest.fixture(scope="module")
def odd_pages(spark):
    big, other = "<p>é" * 400, "\r\n\r\nWARC/1.1\r\n" * 200
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (3, "http://a\r\nX: y", other),
            (4, "", None), (5, "u", ""), (6, "u", "small"), (7, "u", "small"), (8, "u", "x" * 1000),
            (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "x" * 1000)]
    return spark.createDataFrame(rows, PAGES)


def test_round_trip(spark, odd_pages, tmp_path):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    clash = odd_pages.withColumns({c: F.lit(1) for c in ("header", "payload", "address", "sha1")})
    write_archive(clash, path)
    rows = read_archive(spark, path).collect()
    assert digest_columns(rows) == expected_rows(odd_pages.collect())
    texts = {r.page_id: r.html for r in odd_pages.collect()}
    for r in rows:
        assert bytes(r.payload) == (texts[r.page_id] or "").encode()
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and len(fields) == len(lines) - 1
        body = b"" if r.record_type == "revisit" else bytes(r.payload)
        assert rest == body + b"\r\n\r\n" and int(fields["Content-Length"]) == len(body)
        assert bytes(r.header) == head + b"\r\n\r\n"
    assert spark.read.parquet(f"{path}/payloads").count() == len({t or "" for t in texts.values()})


def test_repeated_rows_and_null_ids(spark, tmp_path):
    big = "y" * 2000
    table = spark.createDataFrame([(5, "u", big), (5, "u", big), (None, "u", big), (None, None, None)], PAGES)
    write_archive(table, f"{tmp_path}/a")
    rows = read_archive(spark, f"{tmp_path}/a").collect()
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in rows) == [
        ("5", "response", "None"), ("5", "response", "None"), ("None", "response", "None"),
        ("None", "revisit", "5")]


def test_empty(spark, tmp_path, odd_pages):
    write_archive(odd_pages.limit(0), f"{tmp_path}/e")
    assert read_archive(spark, f"{tmp_path}/e").collect() == []


def test_damage_is_found(spark, tmp_path, odd_pages):
    write_archive(odd_pages, f"{tmp_path}/d")
    payloads = spark.read.parquet(f"{tmp_path}/d/payloads")
    spoiled = payloads.withColumn("payload", F.concat("payload", F.lit(b"x"))).collect()
    spark.createDataFrame(spoiled, payloads.schema).write.mode("overwrite").parquet(f"{tmp_path}/d/payloads")
    with pytest.raises(PySparkException, match="damaged payload"):
        read_archive(spark, f"{tmp_path}/d").collect()
