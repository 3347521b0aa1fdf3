"""Repeated passages by content-defined chunks."""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.texts import stored, unused, utf8

#: Bytes of a chunk: least, mean gap between places where one may end, most.
LEAST, GAP, MOST = 12, 16, 256
#: Characters that neighbouring repeated chunks must cover together.
MIN_RUN = 100
DIGEST_BYTES = 16

#: One random number per byte value; the rolling hash adds them up.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([i]), 1) for i in range(256)], np.uint32)


def cut_points(data: bytes, least: int = 20, gap: int = 28, most: int = MOST) -> list[int]:
    """Ends of the chunks of a text, in bytes; the last is its length.

    A gear hash moves over the bytes, h = 2 h + G[byte], of which the low 16 bits see the
    last 16 bytes. A chunk may end where they are below 65,536 / gap and a character ends.
    So ends depend on nearby bytes alone, and fall into step again soon after a change.
    """
    size = len(data)
    values = np.frombuffer(data, np.uint8)
    h = GEAR[values]
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    whole = np.ones(size, bool)
    whole[:-1] = (values[1:] & 0xC0) != 0x80
    places = np.flatnonzero(((h & np.uint32(0xFFFF)) < 65_536 // gap) & whole) + 1
    ends, last = [], 0
    for place in [*places.tolist(), size]:
        while place - last > most:
            last += most
            while not whole[last - 1]:
                last -= 1
            ends.append(last)
        if place - last >= least or place == size and place > last:
            ends.append(place)
            last = place
    return ends


def chunked(docs: DataFrame) -> DataFrame:
    """(doc_id, ends, high, low, again) per row: chunk ends in characters, the halves of the
    digests, and which chunks repeat an earlier one of the same text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ends", pa.list_(pa.int32())),
                        ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())),
                        ("again", pa.list_(pa.bool_()))])

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns(batch.slice(at, 500)), schema)],
                    schema=schema)

    def columns(batch: pa.RecordBatch) -> tuple[list, ...]:
        ids, ends, high, low, again = batch["doc_id"].to_pylist(), [], [], [], []
        for text in utf8(batch["text"]):
            text = text or b""
            cuts = cut_points(text, LEAST, GAP) if text else []
            own, seen, start = [], set(), 0
            repeated = []
            for end in cuts:
                digest = blake2b(text[start:end], digest_size=DIGEST_BYTES).digest()
                repeated.append(digest in seen)
                seen.add(digest)
                own.append(digest)
                start = end
            if cuts and not text.isascii():
                lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
                cuts = np.cumsum(lead)[np.array(cuts) - 1].tolist()
            ends.append(cuts)
            halves = np.frombuffer(b"".join(own), "<i8").reshape(-1, 2)
            high.append(halves[:, 0])
            low.append(halves[:, 1])
            again.append(repeated)
        return ids, ends, high, low, again

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        chunk, "doc_id bigint, ends array<int>, high array<bigint>, low array<bigint>, "
               "again array<boolean>")


def repeated_spans(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """Passages that occur more than once, one row for each place.

    Columns: doc_id; start and end in characters; first_doc_id, the smallest doc_id with
    a chunk of the passage; n_docs, the most documents that share one of its chunks; and
    ``extra``, false where the passage stands in its first document for the first time.
    Removing the extra spans leaves each passage once.

    A run of neighbouring chunks that all occur elsewhere, of ``min_run`` characters or
    more, is a span; a few words that happen to recur are shorter. The whole run is
    measured. It is then cut where ``extra`` changes; an extra part below ``min_run`` beside
    chunks that stand there first is not extra, so no passage loses its middle. A part that
    is still shorter, beside a longer extra one, stays in its text and is no span.
    Ends of a passage lie up to one chunk inside it, so a few short passages are missed: of
    6,000 random ones of 311 characters 1, of 290 characters 4, of 250 characters 20. A
    stretch that repeats only itself, such as one word on and on, is not found as a rule:
    no place in it is a content-defined end (``periodic_runs`` finds it).

    Rows with the same doc_id are one document. A null doc_id comes after all others.
    Null and empty texts have no chunks. No rows: no rows.

    Chunks are stored once. Half digests are counted first, with partial counts per task,
    so that only chunks whose half digest repeats go on to whole digests. A chunk in very
    many documents is a skewed join key that adaptive execution splits. Only repeated
    chunks go on, and runs are found document by document.
    """
    rows = stored(chunked(docs).withColumn("row", F.monotonically_increasing_id()), "chunks")
    at = F.col("at")
    high = rows.select(F.explode("high").alias("high"))
    likely = high.groupBy("high").count().where("count > 1").select("high")
    start = F.when(at > 0, F.element_at("ends", F.greatest(at, F.lit(1)))).otherwise(0)
    # Start, length (at most MOST) and ``again`` in one number, as all chunks are shuffled.
    place = (start.cast("bigint") * 1024 + (F.col("end") - start) * 2
             + F.element_at("again", at + 1).cast("int"))
    marks = rows.where(F.size("ends") > 0).select(
        "doc_id", "row", "ends", "high", "low", "again",
        F.posexplode("ends").alias("at", "end")).select(
        "doc_id", "row", F.element_at("high", at + 1).alias("high"),
        F.element_at("low", at + 1).alias("low"), place.alias("place"))
    begin = F.shiftright("place", 10)
    chunks = stored(marks.join(likely, "high", "left_semi"), "likely").select(
        "doc_id", "row", "high", "low", begin.alias("start"),
        (begin + F.shiftright("place", 1).bitwiseAND(F.lit(511))).alias("end"),
        (F.col("place") % 2 == 1).alias("again"))
    shared = (chunks.groupBy("high", "low")
              .agg(F.min("doc_id").alias("first_doc_id"),
                   F.max("doc_id").alias("last_doc_id"),
                   F.count(F.when(~F.col("again"), 1)).alias("n_docs"),
                   F.count_if(F.col("doc_id").isNull()).alias("n_null"),
                   F.max("again").alias("within"))
              .where((F.col("first_doc_id") < F.col("last_doc_id")) | F.col("within")
                     | ((F.col("n_null") > 0) & (F.col("n_docs") > 1)))
              .select("high", "low", "first_doc_id", "n_docs"))
    extra = F.col("again") | ~F.col("doc_id").eqNullSafe(F.col("first_doc_id"))
    hits = chunks.join(shared, ["high", "low"]).withColumn("extra", extra)

    order = Window.partitionBy("row").orderBy("start")

    def parts(table: DataFrame) -> DataFrame:
        """Number the runs of a row, and the parts of equal ``extra`` in them."""
        apart = F.coalesce(F.lag("end").over(order) != F.col("start"), F.lit(True))
        change = apart | (F.lag("extra").over(order) != F.col("extra"))
        return (table.withColumns({"apart": apart.cast("int"), "change": change.cast("int")})
                .withColumns({"run": F.sum("apart").over(order), "part": F.sum("change").over(order)})
                .drop("apart", "change"))

    def joined(table: DataFrame, *keys: str) -> DataFrame:
        return table.groupBy(*keys).agg(
            F.first("doc_id").alias("doc_id"), F.min("start").alias("start"),
            F.max("end").alias("end"), F.min("first_doc_id").alias("first_doc_id"),
            F.max("n_docs").alias("n_docs"))

    first = joined(parts(hits), "row", "run", "part", "extra")
    run = Window.partitionBy("row", "run")
    length = F.max("end").over(run) - F.min("start").over(run)
    whole = (first.withColumns({"length": length, "mixed": ~F.min("extra").over(run)})
             .where(F.col("length") >= min_run)
             .withColumn("extra", F.col("extra") & ~(
                 F.col("mixed") & (F.col("end") - F.col("start") < min_run))))
    return (joined(parts(whole.drop("run", "part")), "row", "part", "extra")
            .where(F.col("end") - F.col("start") >= min_run)
            .select("doc_id", F.col("start").cast("int").alias("start"),
                    F.col("end").cast("int").alias("end"), "first_doc_id", "n_docs", "extra"))


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs``, all rows and columns, without the extra ``spans`` of their texts."""
    mark, key = unused("cuts", docs), unused("cut_id", docs)
    cuts = spans.where("extra").groupBy(F.col("doc_id").alias(key)).agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias(mark))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("upto"))

    def keep(state, cut):
        kept = F.substring(F.col("text"), state["upto"] + 1,
                           F.greatest(F.lit(0), cut["start"] - state["upto"]))
        return F.struct(F.concat(state["text"], kept).alias("text"),
                        F.greatest(state["upto"], cut["end"]).alias("upto"))

    rest = F.aggregate(mark, start, keep, lambda s: F.concat(
        s["text"], F.substring(F.col("text"), s["upto"] + 1, F.length("text"))))
    joined = docs.join(cuts, docs["doc_id"].eqNullSafe(cuts[key]), "left")
    return joined.withColumn("text", F.when(F.col(mark).isNull(), F.col("text")).otherwise(rest)
                             ).select(*docs.columns)
