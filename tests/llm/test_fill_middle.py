import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowlens.llm.fill_middle import ExceptionIndex, Marks, cut, fill_in_middle, restored, token_ends

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ALPHABET = "ab \t\nüé€日😀́\xa0"


def brute(doc_id, text, units=TOKEN.findall):
    text = text or ""
    tokens = units(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def rows_of(table):
    out = table.withColumn("again", restored(F.col("output"), F.col("form")))
    return {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.again)
            for r in out.collect()}


def test_query_equals_brute_force(spark, sf_dir, documents):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = {}
    for r in documents.collect():
        *front, output = brute(r.doc_id, r.text)
        expected[r.doc_id] = (*front, digest(output), digest(r.text or ""))
    found = {r.doc_id: tuple(r)[1:] for r in
             entry.queries()["op11_fill_middle"](spark, sf_dir).collect()}
    assert found == expected
    assert {f[1] for f in found.values()} == {"plain", "psm", "spm"}


def test_index_equals_decoding():
    pick = random.Random(2)
    for _ in range(300):
        text = "".join(pick.choices(ALPHABET, k=pick.randint(0, 40)))
        raw = text.encode()
        index = ExceptionIndex(raw)
        places = np.array([len(text[:i].encode()) for i in range(len(text) + 1)])
        chars = np.arange(len(text) + 1)
        assert index.n_chars == len(text)
        assert (index.to_bytes(chars) == places).all() and (index.to_chars(places) == chars).all()
        assert len(index.at_byte) == sum(ord(c) > 127 for c in text)
        ends = token_ends(raw)
        tokens = TOKEN.findall(text)
        assert [len(t.encode()) for t in tokens] == np.diff(ends, prepend=0).tolist()


def test_long_text_of_both_kinds():
    """A million characters, cut by code point: the index holds the multibyte ones alone."""
    text = ("x" * 999 + "日") * 1000
    n, places, chars = cut(text.encode(), 123_456, 987_654, "char")
    assert n == 1_000_000 and chars.tolist() == [123_456, 987_654]
    assert [text.encode()[:p].decode() == text[:c] for p, c in zip(places, chars)] == [True, True]


def test_character_units(make_docs):
    pick = random.Random(4)
    docs = [(i, "".join(pick.choices(ALPHABET, k=i % 30))) for i in range(200)]
    found = rows_of(fill_in_middle(make_docs(*docs), unit="char"))
    for i, text in docs:
        assert found[i] == (*brute(i, text, list), text)


def test_odd_rows(odd_docs, make_docs):
    table = odd_docs.withColumns({c: F.lit(1) for c in ("n", "form", "body", "kind", "found")})
    found = fill_in_middle(table)
    assert found.count() == odd_docs.count()
    assert set(found.columns) == set(table.columns) | {"prefix_chars", "middle_chars", "output"}
    got = rows_of(found)
    for r in odd_docs.collect():
        assert got[r.doc_id] == (*brute(r.doc_id, r.text), r.text or "")
    assert fill_in_middle(odd_docs.limit(0)).collect() == []
    marks = make_docs(*[(i, t) for i, t in enumerate(
        ["a <P> b", "<S>", "x<M>", "< P>", "<P", "<" * 50, "P> <S < P>", "a<\n<S"] * 5)])
    got = rows_of(fill_in_middle(marks, rate=100))
    for r in marks.collect():
        assert got[r.doc_id][5] == r.text
        assert (got[r.doc_id][1] == "plain") == any(m in r.text for m in ("<P>", "<S>", "<M>"))


def test_marks_must_be_told_apart():
    for marks in (("ab", "bc", "x"), ("a", "a", "b"), ("aa", "aab", "x"), ("", "a", "b"),
                  ("aba", "x", "y")):
        with pytest.raises(ValueError):
            Marks(*marks)
    with pytest.raises(ValueError):
        fill_in_middle(None, unit="line")


def test_rates(documents):
    many = documents.select("text").crossJoin(F.broadcast(documents.select("doc_id").limit(20)))
    table = many.select(F.monotonically_increasing_id().alias("doc_id"), "text")
    forms = {r.form: r["count"] for r in fill_in_middle(table).groupBy("form").count().collect()}
    n = sum(forms.values())
    assert abs(forms["plain"] / n - 0.5) < 0.05
    assert abs(forms["spm"] / (n - forms["plain"]) - 0.8) < 0.05
