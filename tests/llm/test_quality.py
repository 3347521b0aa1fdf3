import random
import re
from collections import Counter

import __spark_entry__ as entry
from flowlens.llm.quality import keep_good, quality_rows


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    base = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")), "n_dup_lines": dup,
            "n_repeat_words": len(inside), "base_failed": base}


def test_query_equals_brute_force(spark, sf_dir, documents):
    expected = {r.doc_id: brute(r.text) for r in documents.collect()}
    found = entry.queries()["op5_quality"](spark, sf_dir).collect()
    assert len(found) == len(expected)
    for r in found:
        assert {k: r[k] for k in expected[r.doc_id]} == expected[r.doc_id]
        assert not (r.base_failed and r.kept)
        assert r.kept == (not r.base_failed and not r.reasons)


def test_bands(make_docs):
    pick = random.Random(1)
    syllables = "ka lo mi ter an sel ou pri da en vor ist al ge tu".split()
    prose = " ".join("".join(pick.choices(syllables, k=pick.randint(1, 4))) for _ in range(600))
    varied = " ".join(f"item {i} of the same list of things" for i in range(400))
    noise = " ".join("".join(chr(pick.randint(33, 0x24F)) for _ in range(12)) for _ in range(300))
    half = prose + " " + " ".join(f"row {i % 90}" for i in range(1500))
    rows = {r.doc_id: r for r in quality_rows(make_docs(
        (1, prose), (2, varied), (3, noise), (4, half))).collect()}
    assert rows[1].kept and not rows[1].reasons
    assert "repetitive" in rows[2].reasons
    assert "incompressible" in rows[3].reasons
    assert "repetitive chunks" in rows[4].reasons
    assert not any(rows[i].kept for i in (2, 3, 4))


def test_the_last_chunk_counts(make_docs):
    """Two whole chunks and a repetitive rest: one of three chunks is bad."""
    pick = random.Random(4)
    syllables = "ka lo mi ter an sel ou pri da en vor ist al ge tu".split()
    prose = " ".join("".join(pick.choices(syllables, k=pick.randint(1, 4))) for _ in range(900))
    good, rest = prose[:4096], prose[5000:6000]
    rows = {r.doc_id: r for r in quality_rows(make_docs(
        (1, good + rest), (2, good + "ab " * 333), (3, good + "ab " * 40), (4, prose[:2000]))).collect()}
    assert (rows[1].n_chunks, rows[1].low_chunks, rows[1].reasons) == (3, 0, [])
    assert (rows[2].n_chunks, rows[2].low_chunks) == (3, 1) and "repetitive chunks" in rows[2].reasons
    assert rows[3].n_chunks == 2 and rows[4].n_chunks == 0


def test_high_quality_labels_are_kept(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = documents.join(labels.where("quality = 1"), "doc_id")
    judged = quality_rows(good.select("doc_id", "text"))
    assert judged.where("not base_failed and not kept").count() == 0


def test_odd_rows(odd_docs):
    rows = quality_rows(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id in (1, 2, 3):
            assert (r.n_words, r.word_chars, r.base_failed, r.kept) == (0, 0, True, False)
    kept = keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and [r.doc_id for r in kept.collect()] == [7]
    assert quality_rows(odd_docs.limit(0)).collect() == []
