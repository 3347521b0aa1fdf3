"""A content-addressed WARC archive: payload bytes once, record headers apart."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.texts import stored
from flowlens.sinks.tables import write_table

#: Fixed value: the revisit profile of the WARC standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 1000


def payload_of(html: Column) -> Column:
    return F.coalesce(F.encode(html, "UTF-8"), F.lit(b""))


def header_lines(fields: list[tuple[str, Column]]) -> Column:
    """The header block of a record: version, fields that are not null, an empty line."""
    lines = [F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
             for name, value in fields]
    return F.concat(F.lit("WARC/1.1\r\n"), *[F.coalesce(x, F.lit("")) for x in lines],
                    F.lit("\r\n"))


def one_line(text: Column) -> Column:
    """A value that cannot end a header line early."""
    return F.regexp_replace(text, "[\\x00-\\x1F\\x7F]", " ")


def record_id(page_id: Column, row: Column) -> Column:
    """<urn:uuid:...> from a digest, so that a task that runs again makes it again."""
    d = F.sha2(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), row), 256)
    parts = [F.substring(d, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def digests(pages: DataFrame) -> DataFrame:
    """page_id, url, payload digests and size of every page: the small side of the work."""
    payload = payload_of(F.col("html"))
    return pages.select(
        "page_id", "url", F.sha2(payload, 256).alias("address"), F.sha1(payload).alias("sha1"),
        F.length(payload).cast("bigint").alias("payload_bytes"))


def write_archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                  min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write every page as a WARC record below ``path``.

    ``payloads``: one row per different payload, named by its SHA-256, with the SHA-1 of
    its records' headers. ``headers``: one row per record with its exact header bytes.

    Of records with equal payloads of at least ``min_revisit_bytes``, the one with the
    largest page_id is the response and the others revisit it; smaller payloads are
    always responses. Equal digests with unequal sizes or checksums stop the job.

    Null html is an empty payload, a null url leaves its header out. A null page_id is
    smaller than any other; repeated rows are records of their own, and the ones with the
    largest page_id are all responses. No rows: two empty tables.

    A digest that many pages share is aggregated within each task first, and the join
    back to the pages is one that adaptive execution can split.
    """
    rows = stored(digests(pages), "digests")
    first = rows.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("address").agg(
        F.max("page_id").alias("first_id"))
    records = rows.join(first, "address", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    digest = F.concat(F.lit("sha1:"), F.col("sha1"))
    kind = F.when(revisit, "revisit").otherwise("response")
    row = F.concat_ws("|", "url", "address")
    url = one_line(F.col("url"))
    header = header_lines([
        ("WARC-Type", kind), ("WARC-Record-ID", record_id(F.col("page_id"), row)),
        ("WARC-Date", F.lit(date)), ("WARC-Target-URI", url),
        ("X-Page-ID", F.col("page_id")),
        ("WARC-Payload-Digest", digest), ("X-Payload-Length", F.col("payload_bytes")),
        ("WARC-Profile", F.when(revisit, REVISIT_PROFILE)),
        ("X-Refers-To-Page-ID", F.when(revisit, F.col("first_id"))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")))])
    records.select(F.encode(header, "UTF-8").alias("header"), "address").write.parquet(
        f"{path}/headers")

    payload = payload_of(F.col("html"))
    bytes_ = pages.select(F.sha2(payload, 256).alias("address"), payload.alias("payload"))
    check = F.struct(F.length("payload").alias("n"), F.xxhash64("payload").alias("h"))
    groups = bytes_.groupBy("address").agg(
        F.first("payload").alias("payload"), F.min(check).alias("low"), F.max(check).alias("high"))
    clash = F.raise_error(F.concat(F.lit("different payloads with digest "), F.col("address")))
    (groups.select("address", F.when(F.col("low") == F.col("high"), F.col("payload"))
                   .otherwise(clash.cast("binary")).alias("payload"))
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))


def header_value(header: Column, name: str) -> Column:
    """A field of a header block, null if it is absent."""
    found = F.regexp_extract(header, rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(F.regexp_like(header, F.lit(rf"(?m)^{name}: ")), found)


def read_archive(spark, path: str) -> DataFrame:
    """Every record of an archive, put together again.

    Columns: header (bytes), payload (the full payload, also of revisits), record (the
    bytes of the record as it stands in a WARC file; a revisit has no body), and the
    header's fields. Payloads are checked against the SHA-256 they are stored under and
    the SHA-1 in the header; a mismatch, or a missing payload, stops the job.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    checked = payloads.select(
        "address", F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload"))
        .otherwise(F.raise_error(F.lit("damaged payload")).cast("binary")).alias("payload"),
        F.sha1("payload").alias("sha1"))
    text = F.decode("header", "UTF-8")
    rows = headers.join(checked, "address", "left").withColumns({
        "record_type": header_value(text, "WARC-Type"),
        "url": header_value(text, "WARC-Target-URI"),
        "page_id": header_value(text, "X-Page-ID").cast("bigint"),
        "refers_to": header_value(text, "X-Refers-To-Page-ID").cast("bigint"),
        "stated": F.substring_index(header_value(text, "WARC-Payload-Digest"), ":", -1),
    })
    whole = F.when(F.col("sha1") == F.col("stated"), F.col("payload")).otherwise(
        F.raise_error(F.lit("payload and header do not match")).cast("binary"))
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return rows.withColumn("payload", whole).select(
        "header", "payload",
        F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"),
        "record_type", "page_id", "url", "refers_to")
