import hashlib
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowlens.llm.periodic import (
    RunRule, collapse_rows, neighbours, periodic_runs, stable_segments, word_runs,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, min_length=12, min_periods=2):
    """All lags, all places, and every smaller period tried."""
    found = []
    for q in range(1, len(words) // min_periods + 1):
        at = 0
        while at + q < len(words):
            if words[at] != words[at + q]:
                at += 1
                continue
            to = at
            while to + q < len(words) and words[to] == words[to + q]:
                to += 1
            length = to - at + q
            if length >= max(min_length, min_periods * q):
                run = words[at:at + length]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    found.append((at, length, q))
            at = to
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    rest = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest.encode()).hexdigest())


def test_query_equals_brute_force(spark, sf_dir, documents):
    expected = {r.doc_id: brute(r.doc_id, r.text) for r in documents.collect()}
    found = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256,
                        r.collapsed_sha256)
             for r in entry.queries()["op12_periodic_runs"](spark, sf_dir).collect()}
    assert found == expected
    assert sum(f[0] > 0 for f in found.values()) >= len(found) // 20


@pytest.mark.parametrize("words", [1, 2, 3, 5, 30, 200])
def test_random_words_with_repeats(words):
    pick = random.Random(words)
    seen = 0
    for _ in range(300):
        text = []
        while len(text) < pick.choice([5, 20, 60, 150]):
            part = [b"%d" % pick.randrange(words) for _ in range(pick.randint(1, 14))]
            if pick.random() < 0.4:
                part = (part * pick.randint(1, 6))[:pick.randint(1, 60)]
            text += part
        rule = RunRule(pick.choice([12, 12, 1, 4, 7, 30]), pick.choice([2, 2, 3, 4]))
        runs = word_runs(text, rule)
        assert runs == brute_runs(text, rule.min_length, rule.min_periods)
        seen += len(runs)
    assert seen > 100


def test_segments_hold_no_lone_word():
    """Every run lies in one segment, and the parts of a segment are split again."""
    text = b"a b c d e f a b c d e f x a b y c d".split()
    _, previous, following = neighbours(text)
    assert stable_segments(previous, following, 12) == [(0, 12)]
    assert stable_segments(previous, following, 2) == [(0, 12)]
    crumbling = [b"%d" % (i // 2 if i % 2 == 0 else i // 2 + 2) for i in range(20_000)]
    _, previous, following = neighbours(crumbling)
    assert stable_segments(previous, following, 12) == []


@pytest.mark.parametrize("name, words", [
    ("one", [b"a"] * 50_000), ("two", [b"a", b"b"] * 25_000),
    ("halves", [b"%d" % i for i in range(50_000)] * 2),
    ("crumbling", [b"%d" % (i // 2 if i % 2 == 0 else i // 2 + 2) for i in range(200_000)])])
def test_long_texts_take_little_more_than_linear_time(name, words):
    started = time.process_time()
    runs = word_runs(words)
    assert time.process_time() - started < 10
    assert runs == {"one": [(0, 50_000, 1)], "two": [(0, 50_000, 2)],
                    "halves": [(0, 100_000, 50_000)], "crumbling": []}[name]


def test_odd_rows(odd_docs, make_docs):
    found = periodic_runs(odd_docs)
    rows = found.collect()
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    assert len(rows) == odd_docs.count() and not any(r.runs for r in rows)
    assert {r.doc_id: r.collapsed for r in rows}[5] == "a b c d e"
    assert [(r.n_words, r.collapsed) for r in rows if r.doc_id in (1, 2, 3)] == [(0, "")] * 3
    assert periodic_runs(odd_docs.limit(0)).collect() == []
    table = make_docs((1, None), (2, "a\n b"), (3, "so " + "é è " * 9 + "end"), (3, "x " * 30))
    kept = collapse_rows(table.withColumn("found", F.lit(7)))
    assert kept.columns == [*table.columns, "found"]
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [
        (2, "a\n b"), (3, "so é è end"), (3, "x")]


def test_rule_is_checked():
    with pytest.raises(ValueError):
        RunRule(12, 1)
    with pytest.raises(ValueError):
        RunRule(0, 2)
