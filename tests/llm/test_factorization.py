import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowlens.llm.factorization import (
    STATISTICS, Machine, Shape, Training, classify, features, fit, flat, labelled_sample,
    statistics, train,
)

SHAPE = Shape(word_bits=8, metadata=("source",))


def some_rows(n):
    pick = random.Random(1)
    return [features(" ".join(pick.choices("ab bc cd de ef fg gh".split(), k=i % 9)).encode(),
                     (pick.choice([None, "x", 3]),), SHAPE) for i in range(n)]


def test_margin_equals_all_pairs():
    """The sum-of-squares identity against the double sum over pairs."""
    random_numbers = np.random.default_rng(0)
    machine = Machine(SHAPE, 0.3, random_numbers.normal(size=SHAPE.size).astype(np.float32),
                      random_numbers.normal(size=(SHAPE.size, 5)).astype(np.float32))
    rows = some_rows(30)
    margins, _, _ = machine.margins(*flat(rows))
    for (at, x), margin in zip(rows, margins):
        pairs = sum(float(machine.vectors[i] @ machine.vectors[j]) * a * b
                    for n, (i, a) in enumerate(zip(at, x)) for j, b in list(zip(at, x))[:n])
        assert margin == pytest.approx(0.3 + float(machine.weights[at] @ x) + pairs, abs=1e-3)
    scores = machine.scores(rows)
    assert scores == pytest.approx(1 / (1 + np.exp(-margins.astype(float))), abs=1e-6)


def test_interactions_are_learned():
    """Labels that depend on a pair of words: no weight of single words can give them."""
    pick = random.Random(3)
    shape = Shape(word_bits=10)
    texts, labels = [], []
    for _ in range(600):
        left, right = pick.choice("ab"), pick.choice("cd")
        texts.append(f"{left} {right}".encode())
        labels.append(float((left, right) in (("a", "c"), ("b", "d"))))
    rows = [features(t, (), shape) for t in texts]
    machine = train(rows, np.array(labels), shape, Training(steps=500))
    right = (machine.scores(rows) > 0.5) == np.array(labels)
    assert right.mean() == 1
    flat_machine = Machine(shape, machine.bias, machine.weights, np.zeros_like(machine.vectors))
    assert ((flat_machine.scores(rows) > 0.5) == np.array(labels)).mean() < 0.8


def test_training_repeats_exactly():
    rows = some_rows(50)
    labels = np.arange(50) % 2.0
    a, b = (train(rows, labels, SHAPE, Training(steps=20)) for _ in range(2))
    assert a.bias == b.bias and (a.weights == b.weights).all() and (a.vectors == b.vectors).all()


def test_statistics():
    text = "ONE two ONE\nfive! ###\nfive! ###\n\n9é".encode()
    words = text.split()
    found = dict(zip(STATISTICS, statistics(text, words, Counter(words))))
    assert all(0 <= v <= 1 for v in found.values())
    assert found["distinct"] == 5 / 8 and found["top_word"] == 2 / 8
    assert found["upper"] == pytest.approx(6 / 17)
    assert found["repeated_lines"] == pytest.approx(1 / 4)
    assert found["word_end"] == 4 / 8 and found["echo"] == 0
    assert all(0 <= v <= 1 for v in statistics(b"", [], Counter()))


def test_held_out_documents(spark, sf_dir="/root/testdata/sf0.1"):
    """Documents whose labels were not learned from, by the registered query."""
    found = entry.queries()["op13_quality_classifier"](spark, sf_dir)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1]
    assert len(bad) > 100 and len(good) > 500
    assert sum(r.predicted == 0 for r in bad) / len(bad) >= 0.95
    assert sum(r.predicted == 1 for r in good) / len(good) >= 0.995
    worse = sum(b.score < g.score for b in bad for g in good) / (len(bad) * len(good))
    assert worse >= 0.995
    everything = found.collect()
    assert len(everything) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in everything:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_only_text_and_metadata_count(spark, documents, sf_dir):
    """Other labels of held-out rows, other sources, languages and ids: the same scores."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    how = Training(steps=30)
    machine = fit(documents, labels.where(~held), how=how)
    before = {r.text: r.score for r in classify(documents, machine).collect()}
    other = documents.withColumns({"lang": F.lit("xx"), "source": F.lit("s")})
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(
        F.col("quality")))
    again = fit(other, turned.where(~held), how=how)
    moved = other.withColumn("doc_id", F.col("doc_id") + 1_000_000)
    assert {r.text: r.score for r in classify(moved, again).collect()} == before


def test_sample_is_bounded_and_counts_copies_once(spark, make_docs):
    docs = make_docs(*[(i, "same") for i in range(50)], (50, "other"), (51, "third"), (52, None),
                     (None, "no id"), (0, "same"))
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(53)] + [(50, 1, 0), (99, 1, 0), (None, 1, 0), (51, None, 0),
                                              (51, 7, 0)], "doc_id bigint, quality int, toxic int")
    shape = Shape()
    rows = labelled_sample(docs, labels, "quality", shape, 100).collect()
    targets = {r.text: r.target for r in rows}
    assert len(rows) == 4 and set(targets) == {"same", "other", "third", None}
    assert targets["other"] == 0.5 and targets["third"] == 1 and targets[None] == 0
    assert targets["same"] == pytest.approx(0.5, abs=0.02)
    assert labelled_sample(docs, labels, "quality", shape, 2).count() == 2


def test_odd_rows(spark, odd_docs):
    table = odd_docs.withColumns({c: F.lit("z") for c in ("score", "predicted", "value", "key")})
    labels = spark.createDataFrame([(1, 0), (5, 1), (7, 1)], "doc_id bigint, quality int")
    how = Training(steps=10)
    machine = fit(table, labels, metadata=("n_chars", "source"), how=how)
    found = classify(table, machine)
    rows = found.collect()
    assert set(found.columns) == set(table.columns) and len(rows) == odd_docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert classify(table.limit(0), machine).collect() == []
    for nothing in (fit(table, labels.limit(0)), fit(table.limit(0), labels)):
        assert {r.score for r in classify(table, nothing).collect()} == {0.5}
