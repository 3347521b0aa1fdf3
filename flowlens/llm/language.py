"""Language identification with interpolated Kneser-Ney character models."""

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.texts import once, stored, utf8

ORDER = 5
#: Different texts per language that are counted, and that thresholds are set on, at most in
#: expectation. The driver and the workers hold the n-grams of these only.
FIT_DOCS, CALIBRATION_DOCS = 1_500, 500
MAX_LANGUAGES = 500
#: Numbers (8 bytes) that a worker remembers: one per word and language.
CACHED_CELLS = 1_600_000
#: Numbers (4 bytes) that are worked out at once: one per character and language.
STEP_CELLS = 1_000_000
#: Share of a language's own documents that its threshold rejects.
REJECTED = 0.005
#: Characters that count towards the score; more make no prediction surer.
SCORE_CHARS = 60

#: A letter, and letters and the marks that belong to them.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
UNKNOWN = "und"


def words_of(text: bytes | None) -> list[str]:
    """Runs of letters, with their combining marks, in lower case."""
    return WORD.findall(text.decode().lower()) if text else []


class Rolling:
    """Hashes of the last k characters before some ends, for k = 0, 1, 2, ..."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        mixed = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        self.mixed = mixed ^ (mixed >> np.uint64(29))

    def before(self, ends: np.ndarray, longest: int) -> list[np.ndarray]:
        """Element k: hash of characters end - k up to, not with, end."""
        total, factor = np.zeros(len(ends), np.uint64), 1
        found = [total]
        for k in range(1, longest + 1):
            total = total + self.mixed[ends - k] * np.uint64(factor)
            factor = factor * 0xBF58476D1CE4E5B9 % (1 << 64)
            found.append((total ^ (total >> np.uint64(31))) * np.uint64(2 * k + 1))
        return found


def hash_all(texts: list[str], length: int) -> np.ndarray:
    """Hashes of texts of one length."""
    if not length:
        return np.zeros(len(texts), np.uint64)
    ends = np.arange(1, len(texts) + 1) * length
    return Rolling("".join(texts)).before(ends, length)[length]


@dataclass(frozen=True)
class Table:
    """Values of (hash, language) pairs: a sorted hash array, and for each hash its pairs.

    A hash takes 16 bytes and a pair 6, so an n-gram costs what the languages that have
    it need, however many languages there are.
    """

    keys: np.ndarray
    starts: np.ndarray
    language: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, language: np.ndarray, value: np.ndarray) -> "Table":
        order = np.lexsort((language, keys))
        unique, starts = np.unique(keys[order], return_index=True)
        return Table(unique, np.append(starts, len(keys)), language[order].astype(np.uint16),
                     value[order].astype(np.float32))

    def pairs(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``wanted``, language, value) of all pairs of the wanted hashes."""
        if not len(self.keys):
            return (np.empty(0, np.int64), self.language, self.value)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        place = np.flatnonzero(self.keys[at] == wanted)
        at = at[place]
        sizes = self.starts[at + 1] - self.starts[at]
        first = np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes)
        chosen = first + np.arange(len(first))
        return np.repeat(place, sizes), self.language[chosen], self.value[chosen]

    @property
    def nbytes(self) -> int:
        return self.keys.nbytes + self.starts.nbytes + self.language.nbytes + self.value.nbytes


@dataclass(frozen=True)
class Level:
    """One order of all languages: discounted shares of n-grams, and weights of contexts."""

    grams: Table
    contexts: Table


@dataclass(frozen=True)
class Model:
    languages: list[str]
    alphabet: int
    levels: list[Level]
    thresholds: list[float] | None = None

    @property
    def nbytes(self) -> int:
        return sum(x.grams.nbytes + x.contexts.nbytes for x in self.levels)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word and its end, in each language.

        Work is cut into steps of about ``STEP_CELLS`` characters times languages.
        """
        found, step, size = [], [], 0
        most = max(1, STEP_CELLS // max(1, len(self.languages)))
        for word in words:
            if step and size + len(word) + 1 > most:
                found.append(self._word_scores(step))
                step, size = [], 0
            step.append(word)
            size += len(word) + 1
        found.append(self._word_scores(step) if step else np.empty((0, len(self.languages))))
        return np.concatenate(found)

    def _word_scores(self, words: list[str]) -> np.ndarray:
        order, count = len(self.levels), len(self.languages)
        lengths = np.array([len(w) + 1 for w in words])
        rolling = Rolling("".join(" " * (order - 1) + w + " " for w in words))
        steps = np.ones(lengths.sum(), np.int64)
        starts = np.cumsum(lengths) - lengths
        steps[starts] = order
        ends = np.cumsum(steps)
        grams = rolling.before(ends, order)
        contexts = rolling.before(ends - 1, order - 1)
        p = np.full(len(ends) * count, 1 / self.alphabet, np.float32)
        for k, level in enumerate(self.levels, start=1):
            place, language, value = level.contexts.pairs(contexts[k - 1])
            p[place * count + language] *= value
            place, language, value = level.grams.pairs(grams[k])
            p[place * count + language] += value
        return np.add.reduceat(np.log(p.astype(np.float64)).reshape(-1, count), starts, axis=0)


def smoothed(counts: dict[str, int], order: int) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    """(order, of contexts or not, hashes, values) of one language's counts of full n-grams.

    The highest order uses counts, the others the number of different characters seen
    before the n-gram. One discount per order, n1 / (n1 + 2 n2).
    """
    for k in range(order, 0, -1):
        ones = sum(v == 1 for v in counts.values())
        twos = sum(v == 2 for v in counts.values())
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        totals, kinds = Counter(), Counter()
        for g, n in counts.items():
            totals[g[:-1]] += n
            kinds[g[:-1]] += 1
        yield k, False, hash_all(list(counts), k), np.array(
            [(n - discount) / totals[g[:-1]] for g, n in counts.items()], np.float32)
        yield k, True, hash_all(list(totals), k - 1), np.array(
            [discount * kinds[h] / n for h, n in totals.items()], np.float32)
        counts = Counter(g[1:] for g in counts)


def model_of(languages: list[str], alphabet: int, order: int, level: np.ndarray,
             context: np.ndarray, key: np.ndarray, language: np.ndarray,
             value: np.ndarray) -> Model:
    """A model from rows (order, of contexts or not, hash, language by number, value)."""
    def table(k: int, of_contexts: bool) -> Table:
        own = (level == k) & (context == of_contexts)
        return Table.of(key[own], language[own], value[own])

    levels = [Level(table(k, False), table(k, True)) for k in range(1, order + 1)]
    return Model(languages, max(2, alphabet), levels)


def kneser_ney(counts: dict[str, dict[str, int]], order: int) -> Model:
    """A model from counts of n-grams of the full order, by language."""
    languages = sorted(counts)
    parts = [(k, c, keys, np.full(len(keys), i), values) for i, name in enumerate(languages)
             for k, c, keys, values in smoothed(counts[name], order)]
    level = np.concatenate([np.full(len(p[2]), p[0]) for p in parts])
    context = np.concatenate([np.full(len(p[2]), p[1]) for p in parts])
    alphabet = {g[-1] for own in counts.values() for g in own}
    return model_of(languages, len(alphabet), order, level, context,
                    *[np.concatenate([p[i] for p in parts]) for i in (2, 3, 4)])


def learning_rows(docs: DataFrame, low: float, high: float, per_language: int,
                  sizes: dict[str, int], seed: int) -> DataFrame:
    """About ``per_language`` different texts of each language, by the text's hash in [low, high)."""
    key = F.xxhash64(F.lit(seed), "text")
    place = F.pmod(key, F.lit(1_000_000)) / 1_000_000
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                           for x in (lang, min(1.0, per_language / n))])[F.col("lang")]
    chosen = docs.where((place >= low) & (place < low + (high - low) * share))
    return chosen.select("lang", "text", key.alias("key")).dropDuplicates(["lang", "key"])


def count_grams(rows: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): n-grams of the full order; words are padded with spaces."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), utf8(batch["text"])):
                words[lang].update(words_of(text))
        for lang, own in words.items():
            grams: Counter = Counter()
            for word, n in own.items():
                text = " " * (order - 1) + word + " "
                for at in range(len(word) + 1):
                    grams[text[at:at + order]] += n
            yield pa.RecordBatch.from_pydict({
                "lang": [lang] * len(grams), "gram": list(grams),
                "n": pa.array(grams.values(), pa.int64())}, schema=pa.schema(
                    [("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())]))

    return (rows.mapInArrow(count, "lang string, gram string, n bigint")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def fit_grams(grams: DataFrame, languages: list[str], order: int) -> Model:
    """A model from a stored table of n-grams; each language is worked out in a task of its own.

    The driver gets hashes and values, 23 bytes for each n-gram or context of a language.
    """
    number = {name: i for i, name in enumerate(languages)}

    def smooth(rows: pa.Table) -> pa.Table:
        own = number[rows["lang"][0].as_py()]
        counts = dict(zip(rows["gram"].to_pylist(), rows["n"].to_pylist()))
        parts = [pa.table({
            "level": np.full(len(keys), k, np.int32), "context": np.full(len(keys), c),
            "key": keys.view(np.int64), "language": np.full(len(keys), own, np.int16),
            "value": values}) for k, c, keys, values in smoothed(counts, order)]
        return pa.concat_tables(parts)

    alphabet = grams.select(F.right("gram", F.lit(1))).distinct().count()
    rows = grams.groupBy("lang").applyInArrow(
        smooth, "level int, context boolean, key bigint, language smallint, value float").toArrow()
    level, context, key, language, value = (
        rows[c].to_numpy() for c in ("level", "context", "key", "language", "value"))
    return model_of(languages, alphabet, order, level, context, key.view(np.uint64), language, value)


RESULT = ("lang string, score double, cross_entropy double, rejected boolean, words bigint")
RESULT_ARROW = pa.struct([("lang", pa.string()), ("score", pa.float64()),
                          ("cross_entropy", pa.float64()), ("rejected", pa.bool_()),
                          ("words", pa.int64())])


class Scorer:
    """A model with a bounded memory of words."""

    def __init__(self, model: Model, cells: int = CACHED_CELLS):
        self.model = model
        self.most = max(64, cells // max(1, len(model.languages)))
        self.rows: dict[str, int] = {}
        self.table = np.empty((self.most, len(model.languages)))

    def remember(self, words: set[str]) -> None:
        """Know at most ``most`` words, these among them; there are no more of them."""
        new = [w for w in words if w not in self.rows]
        if len(self.rows) + len(new) > self.most:
            self.rows, new = {}, list(words)
        if new:
            at = len(self.rows)
            self.table[at:at + len(new)] = self.model.word_scores(new)
            self.rows.update(zip(new, range(at, at + len(new))))

    def sums(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Log probability of each text by language.

        Texts are taken together until their words fill half of the memory; the words of
        a longer text are taken in parts.
        """
        found = [np.zeros(len(self.model.languages)) for _ in texts]
        step = 1 + 65_536 // max(1, len(self.model.languages))
        if not self.model.languages:
            return found
        pieces = [(i, words[at:at + self.most // 2]) for i, words in enumerate(texts)
                  for at in range(0, len(words), self.most // 2)]
        waiting, known, size = [], set(), 0
        for i, words in [*pieces, (None, [])]:
            own = set(words)
            size += len(own)
            if waiting and (i is None or size > self.most // 2):
                self.remember(known)
                for j, some in waiting:
                    at = np.fromiter(map(self.rows.__getitem__, some), np.int64, len(some))
                    for low in range(0, len(at), step):
                        found[j] += self.table[at[low:low + step]].sum(axis=0)
                waiting, known, size = [], set(), len(own)
            waiting.append((i, words))
            known |= own
        return found

    def score_all(self, texts: list[bytes | None]) -> list[dict]:
        results = []
        for at in range(0, len(texts), 256):
            split = [words_of(t) for t in texts[at:at + 256]]
            results += [self.score(*pair) for pair in zip(split, self.sums(split))]
        return results

    def score(self, words: list[str], total: np.ndarray) -> dict:
        model = self.model
        if not words or not model.languages:
            return {"lang": UNKNOWN, "score": 0.0, "cross_entropy": None, "rejected": True,
                    "words": 0}
        chars = sum(map(len, words)) + len(words)
        entropy = -total / chars
        best = int(entropy.argmin())
        surest = np.exp((entropy[best] - entropy) * min(chars, SCORE_CHARS))
        limit = model.thresholds[best] if model.thresholds else np.inf
        return {"lang": model.languages[best], "score": float(1 / surest.sum()),
                "cross_entropy": float(entropy[best]), "rejected": bool(entropy[best] > limit),
                "words": len(words)}


_scorers: dict[int, Scorer] = {}


def identify(text: Column, model: Broadcast) -> Column:
    """struct<lang, score, cross_entropy, rejected, words> of a text column.

    The language with the lowest cross-entropy per character; equal ones go to the first
    by name. ``score`` is its share among all languages over ``SCORE_CHARS`` characters at
    most. ``rejected``: the cross-entropy is above the language's threshold. A null text,
    or one without letters, is ``und`` with score 0.
    """
    key = model._jbroadcast.id() if model._jbroadcast is not None else id(model)

    @F.arrow_udf(RESULT)
    def scores(texts: pa.Array) -> pa.Array:
        if key not in _scorers:
            _scorers.clear()
            _scorers[key] = Scorer(model.value)
        return pa.array(_scorers[key].score_all(utf8(texts)), type=RESULT_ARROW)

    return once(scores, text)


def fit(docs: DataFrame, order: int = ORDER, fit_docs: int = FIT_DOCS,
        calibration_docs: int = CALIBRATION_DOCS, seed: int = 11) -> Model:
    """A model of the languages in ``lang``, from text and lang alone.

    Rows without text or lang are left out; a text that many rows have counts once. The
    n-grams of about ``fit_docs`` texts per language are counted on the executors, made
    into a model language by language there, and sent to the driver as hashes and values;
    about ``calibration_docs`` others, none of them counted, give each language the
    threshold that all but ``REJECTED`` of its documents stay under. Both samples are taken
    by a hash of the text. No rows: a model without languages, which answers ``und``.
    """
    spark = docs.sparkSession
    known = docs.where("text is not null and lang is not null").select("text", "lang")
    sizes = {r[0]: max(1, r[1]) for r in known.groupBy("lang").agg(
        F.approx_count_distinct(F.xxhash64("text"))).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    fit_share = fit_docs / (fit_docs + calibration_docs)
    grams = stored(count_grams(learning_rows(
        known, 0.0, fit_share, round(fit_docs / fit_share), sizes, seed), order), "grams") \
        if sizes else None
    languages = sorted(r[0] for r in grams.select("lang").distinct().collect()) if sizes else []
    if not languages:
        return Model([], 2, [])
    model = fit_grams(grams, languages, order)
    held = learning_rows(known, fit_share, 1.0, round(calibration_docs / (1 - fit_share)), sizes, seed)
    shared = spark.sparkContext.broadcast(model)
    scored = held.select("lang", identify(F.col("text"), shared).alias("r"))
    limits = {r[0]: r[1] for r in scored.where("lang = r.lang").groupBy("lang").agg(
        F.percentile_approx("r.cross_entropy", 1 - REJECTED, 10_000)).collect()}
    return Model(model.languages, model.alphabet, model.levels,
                 [limits.get(lang) or float("inf") for lang in model.languages])


def identify_rows(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, score, cross_entropy, rejected, words), one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", identify(F.col("text"), shared).alias("r")).select(
        "doc_id", "r.*")
