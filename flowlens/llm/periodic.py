"""Periodic runs of words, found in the segments that recursive frequency splitting leaves."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.texts import once, unused, utf8

#: Words that are looked at from either end of a segment before the whole of it.
END_WORDS = 256


@dataclass(frozen=True)
class RunRule:
    """A run has at least ``min_length`` words and ``min_periods`` (two or more) periods."""

    min_length: int = 12
    min_periods: int = 2

    def __post_init__(self):
        if self.min_periods < 2 or self.min_length < 1:
            raise ValueError("min_periods must be 2 or more, min_length 1 or more")


def neighbours(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, and the place of each word's previous and next occurrence (-1 and n: none)."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    previous = np.full(len(ids), -1)
    following = np.full(len(ids), len(ids))
    previous[order[1:][same]] = order[:-1][same]
    following[order[:-1][same]] = order[1:][same]
    return ids, previous, following


def stable_segments(previous: np.ndarray, following: np.ndarray,
                    min_length: int) -> list[tuple[int, int]]:
    """The segments of ``min_length`` words or more in which every word occurs twice.

    A run holds each of its words once a period, so twice or more. A word that is alone in
    its segment is in no run there, and no run crosses it: the segment splits at it, and
    the parts are looked at again, since words now may be alone that were not. Segments
    come out in order.

    Both ends are looked at in growing steps before the middle. What a look costs is then
    bounded by the smaller of the parts it gives, so a text whose ends crumble word by
    word costs n log n, not n squared.
    """
    found, todo = [], [(0, len(previous))]
    while todo:
        low, high = todo.pop()
        width = END_WORDS
        while True:
            if 2 * width >= high - low:
                spans = [(low, high)]
            else:
                spans = [(low, low + width), (high - width, high)]
            alone = np.concatenate([
                at + np.flatnonzero((previous[at:to] < low) & (following[at:to] >= high))
                for at, to in spans])
            if len(alone) or len(spans) == 1:
                break
            width *= 2
        if not len(alone):
            if high - low >= min_length:
                found.append((low, high))
            continue
        starts = np.concatenate(([low], alone + 1))
        ends = np.append(alone, high)
        long = ends - starts >= min_length
        todo += zip(starts[long].tolist(), ends[long].tolist())
    return sorted(found)


def stretches(flags: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of every longest stretch of ``least`` true values or more."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def segment_runs(ids: np.ndarray, low: int, high: int, rule: RunRule) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run between two places, by a scan of all lags.

    A run of period q and L words is a stretch of L - q words that equal the word q
    behind them; that is ``least`` words or more. So only every quarter of ``least`` words
    is compared, four neighbouring hits or more are needed, and only around those every
    word: all lags together compare n log n words. Lags grow, so a stretch inside a run
    found before whose period divides the lag is that run again and is skipped unread.
    Any other stretch long enough has no smaller period, since two periods p and q of p + q
    words or more imply their greatest common divisor.
    """
    runs: list[tuple[int, int, int]] = []
    wide: list[tuple[int, int, int]] = []
    for lag in range(1, (high - low) // rule.min_periods + 1):
        least = max((rule.min_periods - 1) * lag, rule.min_length - lag)
        if low + lag + least > high:
            break
        step = max(1, least // 4)
        hits = ids[low:high - lag:step] == ids[low + lag:high:step]
        if not hits.any():
            continue
        wide = [run for run in wide if run[1] > lag]
        known = sorted((start, start + length - lag) for start, length, period in wide
                       if lag % period == 0)
        for first, last in stretches(hits, least // step):
            # Places, first and last one, of a stretch of hits.
            at, to = low + first * step, low + (last - 1) * step
            for left, right in known:
                if left <= at < right:
                    at += -(-(right - at) // step) * step
            if at > to or (to - at) // step + 1 < least // step:
                continue
            begin, end = max(low, at - step + 1), min(high - lag, to + step)
            equal = ids[begin:end] == ids[begin + lag:end + lag]
            for start, stop in stretches(equal, least):
                start, stop = begin + start, begin + stop
                if any(left <= start and stop <= right for left, right in known):
                    continue
                runs.append((start, stop - start + lag, lag))
                wide.append(runs[-1])
    return runs


def word_runs(words: list[bytes], rule: RunRule = RunRule()) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words, by start and period."""
    if len(words) < rule.min_length:
        return []
    ids, previous, following = neighbours(words)
    least = max(rule.min_length, rule.min_periods)
    runs = []
    for low, high in stable_segments(previous, following, least):
        runs += segment_runs(ids, low, high, rule)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, without those that lie in a run behind its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


RUN_TYPE = ("n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>,"
            " collapsed string")
RUN_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
    ("collapsed", pa.string())])


def runs_of(text: Column, rule: RunRule = RunRule()) -> Column:
    """struct of n_words, runs by start and period, and the collapsed text."""
    def one(body: bytes | None) -> dict:
        words = (body or b"").split()
        runs = word_runs(words, rule)
        return {"n_words": len(words), "collapsed": collapsed(words, runs).decode(),
                "runs": [dict(zip(("start", "length", "period"), r)) for r in runs]}

    @F.arrow_udf(RUN_TYPE)
    def found(texts: pa.Array) -> pa.Array:
        return pa.array([one(t) for t in utf8(texts)], type=RUN_ARROW)

    return once(found, text)


def periodic_runs(docs: DataFrame, rule: RunRule = RunRule()) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs``, from doc_id and text.

    Words are separated by ASCII white space and numbered from 0. A run is a stretch of
    words with smallest period q, as long as the rule asks, that neither neighbouring word
    continues. Runs may overlap. ``collapsed`` has the words that no run holds behind its
    first q words, joined by one space. Whole texts are read, whatever their length, one
    at a time; no row leaves its task.

    A null or empty text has no words, no runs and an empty ``collapsed``. Repeated rows
    give repeated rows; a null doc_id stays null. No rows: no rows. Other columns are not
    read.
    """
    return docs.select("doc_id", runs_of(F.col("text"), rule).alias("found")).select(
        "doc_id", "found.*")


def collapse_rows(docs: DataFrame, rule: RunRule = RunRule()) -> DataFrame:
    """The rows of ``docs``, all columns; a text with a run is replaced by its collapsed form.

    Texts without a run, and null texts, stay as they are.
    """
    found = unused("found", docs)
    text = F.when(F.size(f"{found}.runs") > 0, F.col(f"{found}.collapsed")).otherwise(F.col("text"))
    return (docs.withColumn(found, runs_of(F.col("text"), rule))
            .withColumn("text", text).select(*docs.columns))
