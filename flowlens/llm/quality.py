"""Quality rules: word counts, repetition, and bands of compression ratios."""

from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.texts import once, utf8

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bands:
    """Allowed compressed / original size, by least size in bytes.

    The entry with the largest least size that a text reaches applies. Compression finds
    more to share in longer texts, so both limits fall with the size; under the first
    entry nothing is rejected, because headers outweigh the content. The lower limits lie
    about an eighth below the least ratio of documents labelled as good. ``chunks`` holds the
    limits of every whole chunk of ``chunk_bytes``; a text goes when more than
    ``bad_chunks`` of them lie outside, so a repetitive stretch in a long text counts
    even if the whole looks well.
    """

    whole: tuple[tuple[int, float, float], ...] = (
        (128, 0.45, 1.05), (256, 0.46, 0.90), (512, 0.44, 0.82), (1024, 0.41, 0.76),
        (2048, 0.395, 0.70), (4096, 0.375, 0.66), (8192, 0.365, 0.65), (16_384, 0.355, 0.64),
        (32_768, 0.34, 0.63), (65_536, 0.20, 0.62), (1_048_576, 0.16, 0.60))
    chunk_bytes: int = 2048
    chunks: tuple[float, float] = (0.34, 0.74)
    bad_chunks: float = 0.2
    level: int = 3

    def limits(self, size: int) -> tuple[float, float] | None:
        """Lower and upper limit for a text of so many bytes; none under the first entry."""
        reached = [(low, high) for least, low, high in self.whole if size >= least]
        return reached[-1] if reached else None


@dataclass
class Verdict:
    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0
    ratio: float | None = None
    low_chunks: int = 0
    high_chunks: int = 0
    n_chunks: int = 0
    base_failed: bool = True
    kept: bool = False
    reasons: list[str] = field(default_factory=list)


def duplicate_lines(text: bytes) -> int:
    """Lines that have a word and equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the text."""
    windows = list(zip(*[words[i:] for i in range(width)]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, upto = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + width - max(at, upto)
            upto = at + width
    return covered


def judge(text: bytes | None, bands: Bands, compressor: zstandard.ZstdCompressor) -> Verdict:
    """Base rules and compression bands for one text; null counts as empty."""
    v = Verdict()
    text = text or b""
    words = text.split()
    v.n_words = len(words)
    # Continuation bytes do not start a code point.
    v.word_chars = len(text.translate(None, SPACES).decode())
    v.n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    v.n_dup_lines = duplicate_lines(text)
    v.n_repeat_words = repeated_words(words)
    v.base_failed = v.n_words < 50 or 100 * v.n_repeat_words > 50 * v.n_words

    if text:
        v.ratio = len(compressor.compress(text)) / len(text)
    if limits := bands.limits(len(text)):
        if v.ratio < limits[0]:
            v.reasons.append("repetitive")
        if v.ratio > limits[1]:
            v.reasons.append("incompressible")
    size = bands.chunk_bytes
    for at in range(0, len(text) if len(text) >= size else 0, size):
        chunk = text[at:at + size]
        limits = bands.chunks if len(chunk) == size else bands.limits(len(chunk))
        if limits:
            ratio = len(compressor.compress(chunk)) / len(chunk)
            v.n_chunks += 1
            v.low_chunks += ratio < limits[0]
            v.high_chunks += ratio > limits[1]
    if v.low_chunks > bands.bad_chunks * v.n_chunks:
        v.reasons.append("repetitive chunks")
    if v.high_chunks > bands.bad_chunks * v.n_chunks:
        v.reasons.append("incompressible chunks")
    v.kept = not v.base_failed and not v.reasons
    return v


VERDICT_TYPE = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
                " n_repeat_words bigint, ratio double, low_chunks bigint, high_chunks bigint,"
                " n_chunks bigint, base_failed boolean, kept boolean, reasons array<string>")


def quality(text: Column, bands: Bands = Bands()) -> Column:
    """struct of counts, ratios, ``base_failed``, ``kept`` and ``reasons`` for a text.

    A null or empty text has zero counts, a null ratio, and fails the base rule. A
    narrow step: one text at a time, no shuffle.
    """
    @F.arrow_udf(VERDICT_TYPE)
    def verdicts(texts: pa.Array) -> pa.Array:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        return pa.array([vars(judge(t, bands, compressor)) for t in utf8(texts)],
                        type=verdict_arrow())

    return once(verdicts, text)


def verdict_arrow() -> pa.DataType:
    kinds = {"ratio": pa.float64(), "base_failed": pa.bool_(), "kept": pa.bool_(),
             "reasons": pa.list_(pa.string())}
    return pa.struct([(name, kinds.get(name, pa.int64())) for name in vars(Verdict())])


def quality_rows(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """doc_id and the verdict's columns, one row per row of ``docs``."""
    return docs.select("doc_id", quality(F.col("text"), bands).alias("q")).select(
        "doc_id", "q.*")


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is kept."""
    return docs.where(quality(F.col("text"), bands)["kept"])
