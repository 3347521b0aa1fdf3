"""Fill-in-the-middle transformation, with cuts converted by a sparse exception index."""

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.texts import unused, utf8


@dataclass(frozen=True)
class Marks:
    """What stands before the prefix, the suffix and the middle.

    No mark may lie in another or begin with what another ends with; then a mark found in
    an output was put there.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        for x, y in product(self.all(), repeat=2):
            if any(x.endswith(y[:n]) for n in range(1, len(y))) or (x != y and y in x) or not x:
                raise ValueError("marks must not be empty, overlap or hold one another")
        if len(set(self.all())) < 3:
            raise ValueError("marks must differ")

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class ExceptionIndex:
    """Code-point and byte positions of a UTF-8 text.

    Only multibyte characters are recorded: where they start, and how many bytes over one
    each has. Between them a position differs by a constant, so any number of cuts is one
    search in the short list and one addition. A text of ASCII has an empty list.
    """

    def __init__(self, text: bytes):
        if text.isascii():
            self.at_byte = np.empty(0, np.int64)
            excess = self.at_byte
        else:
            data = np.frombuffer(text, np.uint8)
            self.at_byte = np.flatnonzero(data >= 0xC0)
            leads = data[self.at_byte]
            excess = 1 + (leads >= 0xE0).astype(np.int64) + (leads >= 0xF0)
        self.before = np.concatenate(([0], np.cumsum(excess)))
        self.at_char = self.at_byte - self.before[:-1]
        self.n_chars = len(text) - int(self.before[-1])

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut; a cut lies between characters."""
        return cuts - self.before[np.searchsorted(self.at_byte, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return cuts + self.before[np.searchsorted(self.at_char, cuts)]


def token_ends(text: bytes) -> np.ndarray:
    """Byte ends of the tokens: a word with the ASCII white space before it, or what is left."""
    if not text:
        return np.empty(0, np.int64)
    data = np.frombuffer(text, np.uint8)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    words = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    return np.append(words, len(text))


def cut(text: bytes, first: int, second: int, unit: str) -> tuple[int, np.ndarray, np.ndarray]:
    """(units, byte cuts, code-point cuts) for two draws, in order."""
    index = ExceptionIndex(text)
    if unit == "char":
        n = index.n_chars
        chars = np.array(sorted((first % (n + 1), second % (n + 1))))
        return n, index.to_bytes(chars), chars
    ends = token_ends(text)
    n = len(ends)
    at = sorted((first % (n + 1), second % (n + 1)))
    cuts = np.concatenate(([0], ends))[at]
    return n, cuts, index.to_chars(cuts)


CUT_TYPE = "n bigint, prefix_chars bigint, middle_chars bigint, output string"
CUT_ARROW = pa.struct([("n", pa.int64()), ("prefix_chars", pa.int64()),
                       ("middle_chars", pa.int64()), ("output", pa.string())])


def rearranged(text: Column, first: Column, second: Column, form: Column, unit: str,
               marks: Marks) -> Column:
    """struct of units, lengths and output; lengths and output are null for form ``plain``."""
    prefix, suffix, middle = (m.encode() for m in marks.all())

    def one(body: bytes | None, a: int, b: int, kind: str) -> dict:
        body = body or b""
        n, (x, y), (left, right) = cut(body, a, b, unit)
        if kind == "plain":
            return {"n": n}
        head, mid, tail = body[:x], body[x:y], body[y:]
        parts = ([prefix, head, suffix, tail, middle, mid] if kind == "psm"
                 else [suffix, tail, prefix, head, middle, mid])
        return {"n": n, "prefix_chars": int(left), "middle_chars": int(right - left),
                "output": b"".join(parts).decode()}

    @F.arrow_udf(CUT_TYPE)
    def cuts(texts: pa.Array, a: pa.Array, b: pa.Array, kinds: pa.Array) -> pa.Array:
        rows = zip(utf8(texts), a.to_pylist(), b.to_pylist(), kinds.to_pylist())
        return pa.array([one(*r) for r in rows], type=CUT_ARROW)

    return cuts.asNondeterministic()(text, first, second, form)


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits that depend on the seed and the id only."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, rate: int = 50, spm: int = 80, unit: str = "token",
                   seed: int = 42, marks: Marks = Marks()) -> DataFrame:
    """The rows of ``docs`` with n, form, prefix_chars, middle_chars and output.

    A text of n units (``token``: a word with the white space before it; ``char``: a code
    point) is cut at two of its n + 1 places, and the pieces change places behind their
    marks: ``psm`` is prefix, suffix, middle, ``spm`` suffix, prefix, middle. ``rate`` of
    100 texts are rearranged, ``spm`` of 100 of those as spm; the rest is ``plain``, as
    are empty texts and texts that hold a mark. Both cuts may fall together or on an end,
    so pieces may be empty. Whole texts are cut, whatever their length; work and memory
    are those of one text at a time, and no row leaves its task.

    A null text counts as empty and gives an empty output. Rows with equal ids and texts
    give equal results; all rows without an id draw the same numbers. No rows: no rows.
    Columns of ``docs`` with one of the five names are replaced, others stay.
    """
    if unit not in ("token", "char"):
        raise ValueError("unit must be 'token' or 'char'")
    body, found = unused("body", docs), unused("found", docs)
    form = unused("kind", docs)
    first, second, third, fourth = draws(F.col("doc_id"), seed)
    marked = F.lit(False)
    for mark in marks.all():
        marked = marked | F.contains(F.col(body), F.lit(mark))
    plain = (F.col(body) == "") | marked | (third % 100 >= rate)
    chosen = (docs.withColumn(body, F.coalesce("text", F.lit("")))
              .withColumn(form, F.when(plain, "plain").when(fourth % 100 < spm, "spm")
                          .otherwise("psm")))
    cuts = chosen.withColumn(found, rearranged(
        F.col(body), first, second, F.col(form), unit, marks))
    return cuts.withColumns({
        "n": F.col(f"{found}.n"), "form": F.col(form),
        "prefix_chars": F.col(f"{found}.prefix_chars"),
        "middle_chars": F.col(f"{found}.middle_chars"),
        "output": F.coalesce(f"{found}.output", body),
    }).drop(body, found, form)


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output of this form was made from, exactly.

    No piece holds a mark and marks do not overlap, so what lies between two marks, or
    behind the last, is a piece.
    """
    def piece(mark: str) -> Column:
        found = F.split_part(output, F.lit(mark), F.lit(2))
        for other in marks.all():
            if other != mark:
                found = F.split_part(found, F.lit(other), F.lit(1))
        return found

    whole = F.concat(piece(marks.prefix), piece(marks.middle), piece(marks.suffix))
    return F.when(form == "plain", output).otherwise(whole)
