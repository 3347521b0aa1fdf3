import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from flowlens.llm.queries import TOKENIZER
from flowlens.llm.texts import stored
from test_decontamination import brute as brute_hits
from test_packing import check
from test_pii import brute as brute_pseudonyms
from test_simhash import brute_components, brute_print


@pytest.fixture(scope="module")
def outputs(spark, sf_dir, documents):
    docs, found = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = stored(stage(spark, docs, sf_dir), name)
    return found


def rows(table):
    return {r.doc_id: r for r in table.collect()}


def test_stages(spark, sf_dir, documents, outputs):
    """Each stage against a plain version on what the one before it kept."""
    assert list(outputs) == ["quality", "near_duplicates", "decontamination", "pseudonyms", "packing"]
    for name in list(outputs)[:-1]:
        assert outputs[name].columns == documents.columns
    kept = rows(outputs["quality"])
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) >= 50 for r in kept.values())

    roots = brute_components({i: brute_print(r.text) for i, r in kept.items()})
    single = rows(outputs["near_duplicates"])
    assert set(single) == {i for i, root in roots.items() if i == root}

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hits = brute_hits([(i, r.text) for i, r in single.items()], items)
    clean = rows(outputs["decontamination"])
    assert set(clean) == {i for i, h in hits.items() if h[1] == 0}

    private = rows(outputs["pseudonyms"])
    assert {i: r.text for i, r in private.items()} == {
        i: brute_pseudonyms(r.text) for i, r in clean.items()}

    tokenizer = Tokenizer.from_file(TOKENIZER)
    check(outputs["packing"].collect(), {i: r.text for i, r in private.items()},
          lambda t: [*tokenizer.encode(t, add_special_tokens=False).ids, 2])


def test_run(spark, sf_dir, outputs):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == outputs["packing"].columns
    assert found.count() == outputs["packing"].count()


def test_odd_rows(spark, sf_dir, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, sf_dir)
            result.collect()
            if name != "packing":
                assert result.columns == docs.columns
