import hashlib
import re

import pytest

import __spark_entry__ as entry
from flowlens.llm.decontamination import contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BENCHMARK = "item_id bigint, text string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).update(
                [] if item is None else [str(item)])
    result = {}
    for doc, text in docs:
        w, hit, own = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    own |= windows[tuple(w[i:i + size])]
        result[doc] = (len(w), len(hit), len(own), ",".join(sorted(own)))
    return result


def test_query_equals_brute_force(spark, sf_dir, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = brute([(r.doc_id, r.text) for r in documents.collect()], items)
    found = entry.queries()["op8_decontamination"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
            for r in found} == {
        d: (n, h, i, hashlib.sha256(text.encode()).hexdigest(), h > 0)
        for d, (n, h, i, text) in expected.items()}
    assert any(r.contaminated for r in found)


@pytest.fixture(scope="module")
def small(spark, make_docs):
    items = [(1, "Who wrote the Book, of all the old books in town?"), (2, "yes no"), (2, "yes no"),
             (3, None), (4, "..."), (None, "no id here"), (10, "No maybe"), (11, "a b c d e f g h i j k l")]
    docs = make_docs(
        (1, "xx who-WROTE the book of\nall the old books in town yy"), (2, "Yes, no! maybe"),
        (3, "yesno maybe"), (4, "b c d e f g h i j k and a b c d e f g h i j"), (5, "éa yes no"),
        (6, None), (7, "yes no yes no yes no"), (8, "say no id here now"))
    return docs, spark.createDataFrame(items, BENCHMARK)


@pytest.mark.parametrize("block_chars", [10 ** 6, 45, 20])
def test_small_cases(small, block_chars):
    docs, benchmark = small
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    rows = contamination(docs, benchmark, block_chars=block_chars).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    expected = brute(texts.items(), items)
    assert {r.doc_id: (r.n_words, r.n_hit, len(r["items"]), ",".join(r["items"]))
            for r in rows} == expected
    assert expected[2][1:3] == (3, 2) and expected[8] == (5, 3, 0, "")
    for r in rows:
        inside = [w for s in r.spans for w in words(texts[r.doc_id][s.start:s.end])]
        assert len(inside) == r.n_hit
    kept = drop_contaminated(docs, benchmark, block_chars=block_chars)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6]


def test_odd_rows(odd_docs, spark):
    benchmark = spark.createDataFrame([(1, "w0 w7919")], BENCHMARK)
    rows = contamination(odd_docs, benchmark).collect()
    assert len(rows) == odd_docs.count()
    assert [r.doc_id for r in rows if r.n_hit] == [7]
    none = benchmark.limit(0)
    assert all(r.n_hit == 0 for r in contamination(odd_docs, none).collect())
    assert drop_contaminated(odd_docs, none).count() == odd_docs.count()
    assert drop_contaminated(odd_docs, benchmark).columns == odd_docs.columns
    assert contamination(odd_docs.limit(0), benchmark).collect() == []
    blocks = spark.createDataFrame([(1, "w0 w7919"), (2, "a b"), (3, "x y z")], BENCHMARK)
    whole, parts = contamination(odd_docs, blocks), contamination(odd_docs, blocks, block_chars=6)
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    assert sum(r.n_hit > 0 for r in whole.collect()) == 5
