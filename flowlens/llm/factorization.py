"""Text quality by a factorisation machine over words, structure and metadata."""

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.texts import sliced, stored, unused, utf8

#: Distinct labelled texts that a fit uses at most.
FIT_TEXTS = 6_000
#: Feature entries that one step of scoring holds at once (about 100 bytes each).
STEP_ENTRIES = 100_000
#: Rows whose texts are Python objects at a time.
SLICE_ROWS = 512
SYMBOLS = b"#*$%&|<>"
STOPS = b".,;:!?\"'()-"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
STATISTICS = ("length", "word_length", "distinct", "top_word", "upper", "digits", "symbols",
              "stops", "multibyte", "repeated_lines", "line_length", "word_end", "echo")


@dataclass(frozen=True)
class Shape:
    """Where features lie: hashed words, then bins of statistics, then hashed metadata."""

    word_bits: int = 16
    bins: int = 16
    metadata: tuple[str, ...] = ()
    metadata_slots: int = 256

    @property
    def statistics_at(self) -> int:
        return 1 << self.word_bits

    @property
    def metadata_at(self) -> int:
        return self.statistics_at + len(STATISTICS) * (self.bins + 1)

    @property
    def size(self) -> int:
        return self.metadata_at + len(self.metadata) * self.metadata_slots


@dataclass(frozen=True)
class Training:
    """Steps of stochastic descent with AdaGrad rates, on the logistic loss."""

    rank: int = 8
    steps: int = 400
    batch: int = 64
    rate: float = 0.2
    decay: float = 1e-4
    seed: int = 7


def statistics(text: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """The structure of a text as numbers from 0 to 1, in the order of STATISTICS."""
    n, size = len(words), max(1, len(text))
    lines = [x for x in text.split(b"\n") if x.strip()]

    def share(characters: bytes) -> float:
        return (size - len(text.translate(None, characters))) / size if text else 0.0

    upper, lower = share(UPPER), share(LOWER)
    multibyte = 0.0 if text.isascii() else 1 - len(text.decode()) / size
    ends = sum(1 for w in words if w[-1:] in (b"!", b"#", b"*", b"$", b"%", b"&", b"|"))
    return [
        min(1.0, log2(1 + n) / 20),
        min(1.0, len(b"".join(words)) / max(1, n) / 32),
        len(counts) / max(1, n),
        max(counts.values(), default=0) / max(1, n),
        upper / max(1e-9, upper + lower),
        share(DIGITS) ** 0.5,
        share(SYMBOLS) ** 0.5,
        share(STOPS) ** 0.5,
        multibyte ** 0.5,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        min(1.0, log2(1 + n / max(1, len(lines))) / 16),
        ends / max(1, n),
        sum(map(eq, words, words[1:])) / max(1, n),
    ]


def features(text: bytes | None, metadata: Sequence[object],
             shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(positions, values) of the features of one text; null counts as empty.

    Words weigh 1 + log of their count, together of length one. A statistic gives its value and a
    one for its bin; a metadata value gives a one for its slot, and so does a missing one.
    """
    text = text or b""
    words = text.split()
    counts = Counter(words)
    at = np.fromiter(map(crc32, counts), np.int64, len(counts)) & (shape.statistics_at - 1)
    weight = 1 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))
    at, slot = np.unique(at, return_inverse=True)
    weight = np.bincount(slot, weight, len(at)).astype(np.float64)
    weight /= max(1e-9, float(np.sqrt(weight @ weight)))

    values = np.array(statistics(text, words, counts))
    base = shape.statistics_at + np.arange(len(values)) * (shape.bins + 1)
    bins = np.minimum((values * shape.bins).astype(np.int64), shape.bins - 1)
    slots = [shape.metadata_at + i * shape.metadata_slots
             + (0 if v is None else 1 + crc32(repr(v).encode()) % (shape.metadata_slots - 1))
             for i, v in enumerate(metadata)]
    positions = np.concatenate([at, base, base + 1 + bins, np.array(slots, np.int64)])
    amounts = np.concatenate([weight, values, np.ones(len(values) + len(slots))])
    return positions.astype(np.int32), amounts.astype(np.float32)


@dataclass
class Machine:
    """bias, a weight and a vector of ``rank`` numbers for each feature."""

    shape: Shape
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    @classmethod
    def start(cls, shape: Shape, rank: int, seed: int) -> "Machine":
        random = np.random.default_rng(seed)
        return cls(shape, 0.0, np.zeros(shape.size, np.float32),
                   random.normal(0, 0.05, (shape.size, rank)).astype(np.float32))

    def margins(self, at: np.ndarray, x: np.ndarray,
                starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Margins, and for the gradient the sums v x by row and the terms v x.

        All pairs i < j of (v_i . v_j) x_i x_j are half of the squared sum of v x less the
        sum of its squares, for each of the rank numbers: one pass over the features.
        """
        terms = self.vectors[at] * x[:, None]
        sums = np.add.reduceat(terms, starts, axis=0)
        squares = np.add.reduceat(terms * terms, starts, axis=0)
        linear = np.add.reduceat(self.weights[at] * x, starts)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, terms

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Scores from 0 to 1; every row has features, since statistics always give some."""
        found, step, entries = [], [], 0
        for i, row in enumerate(rows):
            step.append(row)
            entries += len(row[0])
            if entries >= STEP_ENTRIES or i + 1 == len(rows):
                margin, _, _ = self.margins(*flat(step))
                found.append(logistic(margin.astype(np.float64)))
                step, entries = [], 0
        return np.concatenate(found) if found else np.empty(0)


def logistic(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def flat(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(at) for at, _ in rows])
    return (np.concatenate([at for at, _ in rows]), np.concatenate([x for _, x in rows]),
            np.cumsum(sizes) - sizes)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, shape: Shape,
          how: Training = Training()) -> Machine:
    """Fit to labels from 0 to 1. No rows: a machine that scores every text 0.5.

    The bias starts at the log odds of the labels. Rows are taken in an order drawn from
    the seed; equal rows in equal order give an equal machine.
    """
    machine = Machine.start(shape, how.rank, how.seed)
    if not rows:
        machine.vectors[:] = 0
        return machine
    odds = np.clip(labels.mean(), 0.01, 0.99)
    machine.bias = float(np.log(odds / (1 - odds)))
    random = np.random.default_rng(how.seed)
    seen_w = np.full(shape.size, 1e-2, np.float32)
    seen_v = np.full((shape.size, how.rank), 1e-2, np.float32)
    order = np.empty(0, np.int64)
    for _ in range(how.steps):
        if len(order) < how.batch:
            order = np.append(order, random.permutation(len(rows)))
        chosen, order = order[:how.batch], order[how.batch:]
        at, x, starts = flat([rows[i] for i in chosen])
        margin, sums, terms = machine.margins(at, x, starts)
        error = (logistic(margin) - labels[chosen]).astype(np.float32) / len(chosen)
        row = np.repeat(np.arange(len(chosen)), np.diff(np.append(starts, len(at))))
        pull = error[row] * x
        used, slot = np.unique(at, return_inverse=True)
        step = np.bincount(slot, pull, len(used)) + how.decay * machine.weights[used]
        seen_w[used] += step * step
        machine.weights[used] -= how.rate * step / np.sqrt(seen_w[used])
        pulls = pull[:, None] * (sums[row] - terms)
        steps = np.stack([np.bincount(slot, pulls[:, f], len(used))
                          for f in range(how.rank)], axis=1)
        steps += how.decay * machine.vectors[used]
        seen_v[used] += steps * steps
        machine.vectors[used] -= how.rate * steps / np.sqrt(seen_v[used])
        machine.bias -= how.rate * float(error.sum())
    return machine


def _rows(batch: pa.RecordBatch | pa.Table, shape: Shape,
          text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    others = [batch.column(c).to_pylist() for c in shape.metadata]
    metadata = zip(*others) if others else ((),) * batch.num_rows
    column = batch.column(text)
    texts = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return [features(t, m, shape) for t, m in zip(utf8(texts), metadata)]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, shape: Shape,
                    texts: int) -> DataFrame:
    """(key, at, text, target and metadata) of at most ``texts`` distinct labelled texts.

    Labels are averaged by document, then by text, so that copies count once. Which texts
    are taken depends on a hash of text and metadata alone. Only ids, hashes and labels
    are shuffled; the chosen rows, ``texts`` of them at most, are broadcast to pick up
    their texts.
    """
    marks = (labels.where(F.col(label).isin(0, 1)).groupBy("doc_id")
             .agg(F.avg(label).alias("target")))
    key = F.xxhash64("text", *shape.metadata)
    chosen = (docs.select("doc_id", key.alias("key")).join(marks, "doc_id")
              .groupBy("key").agg(F.avg("target").alias("target"), F.min("doc_id").alias("at"))
              .orderBy(F.xxhash64("key", F.lit(1)), "key").limit(texts))
    chosen = stored(chosen, "labelled")
    same = (F.col("doc_id") == F.col("at")) & (key == F.col("key"))
    return (docs.select("doc_id", "text", *shape.metadata).join(F.broadcast(chosen), same)
            .dropDuplicates(["key"]).drop("doc_id", "at"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality",
        metadata: tuple[str, ...] = (), texts: int = FIT_TEXTS, shape: Shape | None = None,
        how: Training = Training()) -> Machine:
    """Learn ``label`` (0 or 1) of the documents that ``labels`` (doc_id, label) covers.

    At most ``texts`` distinct texts are learned from, in one task; that bounds what the
    task holds and the model, ``shape.size`` rows of 1 + rank numbers, is all that the
    driver gets. Other labels than 0 and 1, nulls, and ids that ``docs`` lacks count for
    nothing; a document with unlike labels counts with their mean. Without any label every
    text scores 0.5.
    """
    shape = shape or Shape(metadata=tuple(metadata))
    sample = labelled_sample(docs, labels, label, shape, texts)

    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort(rows["key"].to_numpy(), kind="stable")))
        machine = train(_rows(rows, shape, "text"), rows["target"].to_numpy(), shape, how)
        return pa.table({
            "at": pa.array(np.arange(-1, shape.size), pa.int32()),
            "weight": pa.array(np.append(machine.bias, machine.weights), pa.float64()),
            "vector": pa.array([[]] + machine.vectors.tolist(), pa.list_(pa.float32()))})

    model = stored(sample.groupBy(F.lit(1).alias("all")).applyInArrow(
        learn, "at int, weight double, vector array<float>"), "machine")
    rows = model.orderBy("at").toArrow()
    if not rows.num_rows:
        return train([], np.empty(0), shape, how)
    weights = rows["weight"].to_numpy()
    vectors = rows["vector"].combine_chunks().flatten().to_numpy().reshape(shape.size, -1)
    return Machine(shape, float(weights[0]), weights[1:].astype(np.float32), vectors)


def score(machine: Machine, text: Column, *metadata: Column) -> Column:
    """The score of a text column, from 0 to 1."""
    names = machine.shape.metadata

    @F.arrow_udf("double")
    def scores(texts: pa.Array, *others: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts, *others], names=["text", *names])
        found = [machine.scores(_rows(part, machine.shape, "text"))
                 for part in sliced(iter([batch]), SLICE_ROWS)]
        return pa.array(np.concatenate(found) if found else np.empty(0))

    return scores.asNondeterministic()(text, *metadata)


def classify(docs: DataFrame, machine: Machine, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``least``, else 0).

    Reads the whole text and the metadata columns that the machine was fitted with, and
    no other. Null and empty texts score by their structure and metadata. Repeated rows
    score alike. No rows: no rows. Columns of ``docs`` called score or predicted are
    replaced. A narrow step: the machine travels to the tasks, no row leaves its task.
    """
    value = unused("value", docs)
    found = docs.withColumn(value, score(machine, F.col("text"),
                                         *map(F.col, machine.shape.metadata)))
    return found.withColumns({
        "score": F.col(value),
        "predicted": F.when(F.col(value) >= least, 1).otherwise(0)}).drop(value)
