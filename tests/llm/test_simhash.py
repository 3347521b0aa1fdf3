import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowlens.llm.components import connected_components
from flowlens.llm.simhash import ball_links, dealt, keep_one_each, masks, near_duplicates


def brute_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest reachable id by id, over all pairs."""
    parent = {i: i for i in prints}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_equals_brute_force(spark, sf_dir, documents):
    prints = {r.doc_id: brute_print(r.text) for r in documents.collect()}
    roots = brute_components(prints)
    found = entry.queries()["op7_simhash"](spark, sf_dir).collect()
    assert len(found) == len(prints)
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in found} == roots
    assert len(set(roots.values())) < len(roots)


@pytest.mark.parametrize("options", [{}, {"task_variants": 3000}, {"prefix_bits": 5},
                                     {"prefix_bits": 12, "task_variants": 2000}])
def test_links_connect_all_near_prints(spark, options):
    """Clusters around a few centres, so that prefixes are hot."""
    pick = random.Random(5)
    prints = set()
    for centre in (0, (1 << 64) - 1, pick.getrandbits(64), pick.getrandbits(64)):
        near = centre
        for _ in range(60):
            prints.add(near)
            start = centre if pick.random() < 0.7 else near
            near = start ^ sum(1 << b for b in pick.sample(range(64), pick.choice([1, 3, 4, 5, 8])))
    prints |= {pick.getrandbits(64) for _ in range(200)}
    table = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    links = ball_links(table, 4, **options)
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links.collect()]
    assert {x for p in pairs for x in p} <= prints

    neighbours = {p: [] for p in prints}
    for a, b in pairs:
        neighbours[a].append(b)
        neighbours[b].append(a)

    def reach(start, near):
        seen, todo = {start}, [start]
        while todo:
            for n in near(todo.pop()):
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return seen

    for p in prints:
        expected = reach(p, lambda x: [y for y in prints if (x ^ y).bit_count() <= 4])
        assert reach(p, neighbours.__getitem__) == expected


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3, 4, 5])
def test_every_radius_equals_brute_force(spark, max_bits):
    """Dense clusters, where the smallest owner of a variant is often too far from another."""
    pick = random.Random(max_bits)
    prints = {2, 5, 6, 7}
    for _ in range(4):
        centre = pick.getrandbits(64)
        spots = pick.sample(range(64), 14)
        for _ in range(40):
            prints.add(centre ^ sum(1 << b for b in pick.sample(spots, pick.randint(0, 7))))
    table = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    links = ball_links(table, max_bits, task_variants=200_000 if max_bits == 5 else 20_000)
    pairs = {(r.a % (1 << 64), r.b % (1 << 64)) for r in links.collect()}
    wanted = brute_groups(prints, lambda x, y: (x ^ y).bit_count() <= max_bits)
    assert brute_groups(prints, lambda x, y: (x, y) in pairs or (y, x) in pairs) == wanted
    assert max_bits == 0 or 4 < len(wanted) < len(prints)


def brute_groups(prints, linked):
    """Sets of connected fingerprints."""
    left, groups = set(prints), set()
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if linked(x, y)}
            left -= near
            group |= near
            todo += near
        groups.add(frozenset(group))
    return groups


def test_work_of_a_hot_cluster_is_proportional(spark):
    """20,000 near copies: every variant is dealt once, and no prefix holds too many."""
    pick = random.Random(8)
    centre = pick.getrandbits(64)
    prints = {centre}
    while len(prints) < 20_000:
        prints.add(centre ^ sum(1 << b for b in pick.sample(range(64), pick.randint(1, 5))))
    table = spark.createDataFrame([(signed(p),) for p in prints], "fp bigint")
    made, levels = 0, dealt(table, 2, 500_000)
    assert len(levels) > 1
    for bits, rows in levels:
        size = F.element_at(F.array(*[F.lit(len(masks(64 - bits, n))) for n in range(3)]),
                            F.col("left") + 1)
        groups = rows.groupBy("dest").agg(F.sum(size).alias("n"), F.count("fp").alias("rows"))
        row = groups.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
        made += row.n
        assert row.most <= 125_000
    assert made == 20_000 * 2081
    roots = connected_components(ball_links(table, 4)).select("root").distinct().count()
    assert roots == 1


def test_rows_of_a_split_level_are_made_once(spark):
    """What stays and what is split further are read from one stored table, not made again."""
    near = [5 ^ sum(1 << b for b in c) for n in range(3) for c in itertools.combinations(range(20), n)]
    levels = dealt(spark.createDataFrame([(p,) for p in near], "fp bigint"), 2, 20_000)
    assert len(levels) > 1
    for _, rows in levels[:-1]:
        assert "Generate" not in rows._jdf.queryExecution().optimizedPlan().toString()
    last = levels[-1][1]._jdf.queryExecution().optimizedPlan().toString()
    assert last.count("Generate") == 1


def test_chain_and_star_components(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    links = spark.createDataFrame(chain + star + [(5, 4), (7, 7), (None, 3)], "a bigint, b bigint")
    found = {r.node: r.root for r in connected_components(links).collect()}
    assert found == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)}
    assert connected_components(links.limit(0)).collect() == []


def test_odd_rows(odd_docs):
    found = near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    empty = [r for r in found if r.fp == 0]
    assert {r.doc_id for r in empty} >= {1, 2, 3} and {r.component_id for r in empty} == {1}
    assert near_duplicates(odd_docs.limit(0)).collect() == []


def test_keep_one_each(odd_docs, make_docs):
    kept = keep_one_each(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 4, 5, 7, 8, 9]
    assert sum(r.doc_id is None for r in rows) == 1
    assert keep_one_each(odd_docs.limit(0)).collect() == []
    same = make_docs((3, "a b c d"), (2, "a b c d"), (2, "p q r s"), (9, "a b c d"))
    assert sorted((r.doc_id, r.text) for r in keep_one_each(same).collect()) == [
        (2, "a b c d"), (2, "p q r s")]


def test_stage_keeps_one_of_each_component(documents):
    found = near_duplicates(documents)
    n = found.select("component_id").distinct().count()
    kept = keep_one_each(documents)
    assert kept.count() == n
    assert kept.join(found.where("keeper"), "doc_id", "left_anti").count() == 0
    assert found.where(F.col("keeper") & (F.col("doc_id") != F.col("component_id"))).count() == 0
