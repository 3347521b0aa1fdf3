"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.components import connected_components
from flowlens.llm.texts import once, stored, unused, utf8

BITS = 64
#: Variants that one task sorts at once (about 40 bytes each with all copies).
TASK_VARIANTS = 500_000
#: Bits by which a prefix with too many variants is split.
STEP_BITS = 8
#: Prefixes to split that are broadcast; a longer list is joined by a shuffle.
LISTED_PREFIXES = 100_000


def simhash(text: bytes | None, shingle_words: int, seed: int) -> int:
    """The fingerprint of one text, as an unsigned number.

    A-Z are lower-cased, words are separated by ASCII white space, shingles are joined
    by one space and count as often as they occur; a shorter text is one shingle. A bit
    is set if it is set in over half the hashes. No words, or null: zero.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle_words, len(words))
    spans = zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[s:e], seed) for s, e in spans), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 32_768):
        part = hashes[at:at + 32_768].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = 4, seed: int = 42) -> Column:
    """The SimHash of a text column as a bigint (the 64 bits, signed)."""
    @F.arrow_udf("bigint")
    def values(texts: pa.Array) -> pa.Array:
        found = [simhash(t, shingle_words, seed) for t in utf8(texts)]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return once(values, text)


def masks(bits: int, flips: int) -> list[int]:
    """Every pattern of at most ``flips`` set bits among the lowest ``bits``."""
    return [sum(1 << i for i in chosen) for n in range(flips + 1)
            for chosen in combinations(range(bits), n)]


def colliding(values: np.ndarray, owners: np.ndarray,
              inner: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(owner, smallest inner owner) of every variant that two owners have.

    ``inner`` marks the variants that count as such; without it all do.
    """
    ordered = np.sort(values)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(repeated):
        return owners[:0], owners[:0]
    at = np.minimum(np.searchsorted(repeated, values), len(repeated) - 1)
    shared = np.flatnonzero(repeated[at] == values)
    at, owners = at[shared], owners[shared]
    none = np.iinfo(owners.dtype).max
    smallest = np.full(len(repeated), none, owners.dtype)
    chosen = slice(None) if inner is None else inner[shared]
    np.minimum.at(smallest, at[chosen], owners[chosen])
    linked = (smallest[at] != none) & (smallest[at] != owners)
    return owners[linked], smallest[at][linked]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (node, smallest node reached) that the given links imply."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = label != np.arange(len(nodes))
    return nodes[linked], nodes[label[linked]]


def next_bits(bits: int, step: int) -> Column:
    """The ``step`` bits of ``fp`` behind the first ``bits``."""
    return F.shiftrightunsigned("fp", BITS - bits - step).bitwiseAND((1 << step) - 1)


def flips_of(step: int, half: int) -> Column:
    """Array of (mask, left) for a row with ``left`` flips: all masks of ``step`` bits."""
    by_left = [F.array(*[F.struct(F.lit(m).cast("bigint").alias("mask"),
                                  F.lit(left - m.bit_count()).alias("left"))
                         for m in masks(step, left)]) for left in range(half + 1)]
    return F.element_at(F.array(*by_left), F.col("left") + 1)


def dealt(prints: DataFrame, half: int, task_variants: int,
          prefix_bits: int | None = None) -> list[tuple[int, DataFrame]]:
    """(bits, rows) by level; rows are (fp, dest, left), and ``dest`` the first ``bits`` bits.

    Each row stands for the variants of a fingerprint that begin with ``dest`` and have up
    to ``left`` flips behind it. All levels together hold every variant once. A prefix
    that would get over a quarter of ``task_variants`` is not given out but split by
    STEP_BITS further bits, at the next level, together with the others that are too big; a
    fingerprint has at most as many rows as variants, however many others are near it.
    """
    total = prints.count() * len(masks(BITS, half))
    if prefix_bits is None:
        groups = max(1, 8 * total // task_variants)
        prefix_bits = min(40, max(4, (groups - 1).bit_length()))
    waiting, bits, step, levels = prints.select(
        "fp", F.lit(0).cast("bigint").alias("dest"), F.lit(half).alias("left")), 0, prefix_bits, []
    while True:
        rest = BITS - bits - step
        made = F.element_at(F.array(*[F.lit(len(masks(rest, n))).cast("bigint")
                                      for n in range(half + 1)]), F.col("flip.left") + 1)
        dest = F.shiftleft("dest", step).bitwiseOR(F.col("own").bitwiseXOR(F.col("flip.mask")))
        owns = waiting.withColumn("own", next_bits(bits, step))
        flips = F.explode(flips_of(step, half)).alias("flip")
        big = (owns.groupBy("dest", "left", "own").count().select("dest", "own", "count", flips)
               .groupBy(dest.alias("dest")).agg(F.sum(F.col("count") * made).alias("variants"))
               .where(F.col("variants") > task_variants // 4).select("dest"))
        routed = owns.select("fp", "dest", "own", flips).select(
            "fp", dest.alias("dest"), F.col("flip.left").alias("left"))
        bits += step
        big = stored(big, "big_prefixes") if bits < BITS else big.limit(0)
        n_big = big.count() if bits < BITS else 0
        if not n_big:
            return [*levels, (bits, routed)]
        listed = F.broadcast(big) if n_big <= LISTED_PREFIXES else big
        marked = stored(routed.join(listed.withColumn("split", F.lit(True)), "dest", "left"),
                        "routed")
        levels.append((bits, marked.where("split IS NULL").drop("split")))
        waiting = marked.where("split").drop("split")
        step = min(STEP_BITS, BITS - bits)


def ball_links(prints: DataFrame, max_bits: int = 4, prefix_bits: int | None = None,
               task_variants: int = TASK_VARIANTS) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``max_bits`` of each other.

    ``prints`` has one bigint column ``fp`` of distinct fingerprints. Two fingerprints
    differ in at most r bits exactly if some value is within half of r of both, so every
    fingerprint stands for all its variants with up to half of r flipped bits. For an odd
    r one of two must be within the greater half and the other within the smaller: variants
    have up to the greater half of flips, and those with fewer are inner ones.

    Variants meet in tasks chosen by their leading bits. A fingerprint is sent once to each
    prefix that its variants have, with the flips that are left for the other bits, and
    the receiving task makes the variants there: 64 bits and r = 4 are 2,081 variants, but
    only 37 rows for 8 bits and 301 for 24. ``dealt`` splits prefixes with many variants by
    further bits, so a task makes about ``task_variants`` whatever the data, and no variant
    is made twice.

    Every owner of a variant is linked to the smallest inner owner, which is within r; all
    pairs that must be linked are then connected through it. A task returns its links as a
    forest: for each fingerprint the smallest one it is connected with there. So a group
    of n near copies gives about n links a task, never n squared.
    """
    half, odd = (max_bits + 1) // 2, max_bits % 2
    found = None
    for bits, rows in dealt(prints, half, task_variants, prefix_bits):
        links = met(rows, BITS - bits, half, odd, max_bits, task_variants)
        found = links if found is None else found.union(links)
    return found.distinct()


def met(rows: DataFrame, rest: int, half: int, odd: int, max_bits: int,
        task_variants: int) -> DataFrame:
    """Links of the variants of rows (fp, dest, left), which flip the last ``rest`` bits.

    Prefixes are dealt to buckets of about half of ``task_variants``, so that many small
    ones share a call.
    """
    patterns = [np.array(masks(rest, n), np.uint64) for n in range(half + 1)]
    made = F.element_at(F.array(*[F.lit(len(p)).cast("bigint") for p in patterns]),
                        F.col("left") + 1)
    variants = rows.agg(F.sum(made)).first()[0] or 0
    buckets = max(1, -(-2 * variants // task_variants))

    def meet(table: pa.Table) -> pa.Table:
        prints, owner = np.unique(table["fp"].to_numpy().view(np.uint64), return_inverse=True)
        left = table["left"].to_numpy()
        low = np.uint64((1 << rest) - 1)
        base = ((table["dest"].to_numpy().view(np.uint64) << np.uint64(rest))
                | (prints[owner] & low))
        sizes = np.array([len(p) for p in patterns])[left]
        values = np.empty(sizes.sum(), np.uint64)
        owners = np.empty(len(values), np.int32)
        inner = np.ones(len(values), bool) if odd else None
        to = 0
        for n, flips in enumerate(patterns):
            own = np.flatnonzero(left == n)
            at, to = to, to + len(own) * len(flips)
            np.bitwise_xor(base[own][:, None], flips[None, :],
                           out=values[at:to].reshape(len(own), len(flips)))
            owners[at:to] = np.repeat(owner[own].astype(np.int32), len(flips))
            if odd:
                inner[at:to] = np.tile(np.bitwise_count(flips) < n, len(own))
        one, other = colliding(values, owners, inner)
        a, b = prints[one], prints[other]
        near = np.bitwise_count(a ^ b) <= max_bits
        a, b = forest(a[near], b[near])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    bucket = F.pmod(F.xxhash64("dest"), F.lit(buckets))
    return rows.groupBy(bucket.alias("bucket")).applyInArrow(meet, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, max_bits: int = 4, shingle_words: int = 4,
                    seed: int = 42) -> DataFrame:
    """(doc_id, fp, component_id, keeper) of every row of ``docs``, from doc_id and text.

    ``component_id`` is the smallest doc_id that can be reached over links of at most
    ``max_bits`` differing bits; ``keeper`` is true for the one row of the component with
    the smallest (doc_id, fp), and for rows that repeat it. Equal texts have equal
    fingerprints and are one node of the link graph, so exact copies make no links.

    Null or empty texts have fingerprint zero and are linked like any other. A null
    doc_id never is a component_id unless all doc_ids of the component are null. No rows:
    no rows. Other columns are not read.
    """
    prints = stored(docs.select("doc_id", fingerprint(F.col("text"), shingle_words, seed)
                                .alias("fp")), "simhash")
    return with_components(prints, max_bits)


def with_components(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Add component_id and keeper to stored (doc_id, fp) rows."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "fp"))
    nodes = stored(prints.groupBy("fp").agg(first.alias("first")), "fingerprints")
    roots = connected_components(ball_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("best"))
    named = rooted.join(lowest, "root").select(
        "fp", F.col("best.doc_id").alias("component_id"), F.col("best.fp").alias("best_fp"))
    found = prints.join(named, "fp")
    keeper = (F.col("fp") == F.col("best_fp")) & F.col("doc_id").eqNullSafe(
        F.col("component_id"))
    return found.select("doc_id", "fp", "component_id", keeper.alias("keeper"))


def keep_one_each(docs: DataFrame, max_bits: int = 4, shingle_words: int = 4,
                  seed: int = 42) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of every near-duplicate component.

    The row with the smallest doc_id stays; of rows that repeat it with an equal
    fingerprint, any one. Texts are stored once with their fingerprint and shuffled once,
    to meet the list of rows to keep on (fingerprint, doc_id), a key that no group of
    copies can make hot.
    """
    mark = unused("fp", docs)
    whole = stored(docs.withColumn(mark, fingerprint(F.col("text"), shingle_words, seed)),
                   "fingerprinted")
    found = with_components(whole.select("doc_id", F.col(mark).alias("fp")), max_bits)
    kept = found.where("keeper").select(
        F.col("doc_id").alias("kept_id"), F.col("fp").alias("kept_fp")).distinct()
    same = (F.col(mark) == kept["kept_fp"]) & whole["doc_id"].eqNullSafe(kept["kept_id"])
    return (whole.join(kept, same, "left_semi").dropDuplicates([mark, "doc_id"])
            .select(*docs.columns))
