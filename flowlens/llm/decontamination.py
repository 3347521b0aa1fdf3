"""Benchmark decontamination with one Aho-Corasick automaton."""

import hashlib
import re
from bisect import bisect_right
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.texts import once, stored, utf8

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Benchmark text, in characters, that one automaton is built from (about 250 MB per worker
#: at 10 words a window). A larger benchmark is scanned in several passes.
BLOCK_CHARS = 500_000


def windows_of(text: str | None, width: int) -> list[str]:
    """Padded word windows of a benchmark text; a short text is one window."""
    words = WORD.findall((text or "").encode().lower().decode())
    if not words:
        return []
    return [" " + " ".join(words[i:i + width]) + " "
            for i in range(max(1, len(words) - width + 1))]


class Scanner:
    """Finds all windows of some benchmark items in a text, in one pass."""

    def __init__(self, items: list[tuple], width: int):
        owners: dict[str, set] = {}
        for item, text in items:
            for window in windows_of(text, width):
                owners.setdefault(window, set()).update(() if item is None else (item,))
        self.machine = ahocorasick.Automaton()
        for window, own in owners.items():
            self.machine.add_word(window, (len(window), tuple(own)))
        if owners:
            self.machine.make_automaton()
        self.empty = not owners

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int, int, int]], set]:
        """Number of words; (first word, last word, start, end) of merged hits; item ids.

        The scanned text is normalised: words in lower case with one space between and
        around. A window carries its spaces, so it only matches whole words. ``start``
        and ``end`` are offsets of the original text in code points.
        """
        text = (text or b"").lower().decode()
        words = WORD.findall(text)
        if self.empty or not words:
            return len(words), [], set()
        runs: list[list[int]] = []
        items: set = set()
        ends = None
        for end, (length, own) in self.machine.iter(" " + " ".join(words) + " "):
            if ends is None:
                ends = np.cumsum([len(w) + 1 for w in words]).tolist()
            items.update(own)
            # The space after word i is at ends[i]; the space before it at ends[i - 1].
            last = bisect_right(ends, end) - 1
            first = bisect_right(ends, end - length + 1)
            while runs and runs[-1][0] >= first:
                runs.pop()
            if runs and runs[-1][1] >= first:
                runs[-1][1] = max(runs[-1][1], last)
            else:
                runs.append([first, last])
        if not runs:
            return len(words), [], items
        spans = [m.span() for m in WORD.finditer(text)]
        return len(words), [(a, b, spans[a][0], spans[b][1]) for a, b in runs], items


_scanners: dict[str, Scanner] = {}


def scanner_of(key: str, items: Broadcast, width: int) -> Scanner:
    """The worker's scanner of a block; a worker keeps one, built on first use."""
    if key not in _scanners:
        _scanners.clear()
        _scanners[key] = Scanner(items.value, width)
    return _scanners[key]


FOUND = ("n_words bigint, runs array<struct<first:bigint,last:bigint,start:bigint,end:bigint>>,"
         " items array<string>")
FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("first", "last", "start", "end")]))),
    ("items", pa.list_(pa.string())),
])


@dataclass(frozen=True)
class Block:
    """Some benchmark rows (item, text), as the workers fetch them, and a name for them."""

    key: str
    items: Broadcast


def found_in(text: Column, block: Block, width: int) -> Column:
    """struct<n_words, runs, items> of a text against one block of benchmark items."""
    key, items = f"{block.key}-{width}", block.items

    @F.arrow_udf(FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        scanner = scanner_of(key, items, width)
        rows = []
        for text in utf8(texts):
            n, runs, own = scanner.scan(text)
            rows.append({"n_words": n, "items": sorted(own), "runs": [
                dict(zip(("first", "last", "start", "end"), run)) for run in runs]})
        return pa.array(rows, type=FOUND_ARROW)

    return once(scan, text)


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[Block]:
    """``benchmark`` in parts of about ``block_chars``, by a hash of the row.

    The size is measured first. The driver reads one part at a time and hands it to
    Spark's broadcast, which keeps it in files; workers fetch a part when they scan with
    it.
    """
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // block_chars))
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(
        "text is not null").distinct()
    share = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    blocks = []
    for part in range(parts):
        items = sorted(map(tuple, rows.where(share == part).collect()),
                       key=lambda row: (row[0] or "", row[1]))
        key = hashlib.sha256(repr(items).encode()).hexdigest()
        blocks.append(Block(key, benchmark.sparkSession.sparkContext.broadcast(items)))
    return blocks


def merged(found: Column) -> Column:
    """struct<n_words, n_hit, spans, items>: union of what the blocks found in one text."""
    runs = F.array_sort(F.flatten(F.transform(found, lambda f: f["runs"])))
    start = F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
                     F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("upto"))

    def add(state: Column, run: Column) -> Column:
        spans, upto = state["spans"], state["upto"]
        last = F.try_element_at(spans, F.lit(-1))
        apart = F.struct(run["start"].alias("start"), run["end"].alias("end"))
        longer = F.struct(last["start"].alias("start"),
                          F.greatest(last["end"], run["end"]).alias("end"))
        before = F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0)))
        fresh = run["last"] - F.greatest(upto, run["first"] - 1)
        return F.struct(
            F.when(run["first"] > upto, F.concat(spans, F.array(apart)))
            .otherwise(F.concat(before, F.array(longer))).alias("spans"),
            (state["n"] + F.greatest(F.lit(0), fresh)).alias("n"),
            F.greatest(upto, run["last"]).alias("upto"))

    total = F.aggregate(runs, start, add)
    items = F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda f: f["items"]))))
    return F.struct(found[0]["n_words"].alias("n_words"), total["n"].alias("n_hit"),
                    total["spans"].alias("spans"), items.alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items): one row per row of ``docs``.

    A window is ``width`` consecutive words of a benchmark text, a shorter text is one
    window. ``n_hit`` counts the document's words inside any occurrence of a window,
    ``spans`` are the merged hits as code point offsets into the original text, ``items``
    the sorted ids (as text) of items with an occurring window. Benchmark rows without an
    id hit as others do and add no id; rows without text are left out; repeated rows count
    once. A null text has no words. An empty benchmark hits nothing.

    Only the benchmark goes to the workers, in blocks of measured size, each one automaton.
    One block is one narrow step. For several, texts are stored once with a row number and
    each block is a pass of its own over them, so no worker holds two automata; what the
    later passes found, rows with a hit, is brought together by row number.
    """
    blocks = benchmark_blocks(benchmark, block_chars)
    if len(blocks) == 1:
        found = docs.select("doc_id", F.array(
            found_in(F.col("text"), blocks[0], width)).alias("found"))
        return found.select("doc_id", merged(F.col("found")).alias("c")).select("doc_id", "c.*")
    numbered = stored(docs.select("doc_id", "text").withColumn(
        "row", F.monotonically_increasing_id()), "numbered")
    passes = None
    for block in blocks:
        found = numbered.select("row", "doc_id", found_in(F.col("text"), block, width).alias("found"))
        if passes is not None:
            found = found.where(F.size("found.runs") > 0)
        found = stored(found, "found")
        passes = found if passes is None else passes.union(found)
    together = passes.groupBy("row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.collect_list("found").alias("found"))
    return together.select("doc_id", merged(F.col("found")).alias("c")).select("doc_id", "c.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10,
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window occurs.

    Several blocks are passes over what the one before kept, stored between.
    """
    for i, block in enumerate(benchmark_blocks(benchmark, block_chars)):
        docs = stored(docs, "clean") if i else docs
        docs = docs.where(F.size(found_in(F.col("text"), block, width)["runs"]) == 0)
    return docs
