"""Near-duplicates against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediamix.llm import minhash
from mediamix.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_sets(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent):
    """{row number: (n_shingles, component)} by comparing all pairs."""
    sets = [brute_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(key, least.get(find(i), key))
    return {(key, len(sets[i]), least[find(i)]) for i, (key, _) in enumerate(rows)}


def family(rng, size, words, edits):
    """Copies of one text, each with a few words changed: no single text is near to all."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(size):
        copy = list(base)
        for at in rng.sample(range(words), edits):
            copy[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def ours(spark, docs, percent=85):
    return {(r[0], r[1], r[2]) for r in minhash.near_duplicates(docs, percent=percent).select("doc_id", "n_shingles", "component_id").collect()}


def test_whole_small_table(spark, docs, texts):
    assert ours(spark, docs(texts)) == brute(texts, 85)


@pytest.mark.parametrize("percent", [80, 85])
def test_families_whose_members_are_near_to_some_only(spark, docs, percent):
    rng = random.Random(5)
    found = [t for edits in (1, 2, 3) for t in family(rng, 25, 120, edits)] + family(rng, 6, 7, 1) + ["one two", "ONE Two", "one  two three"]
    rng.shuffle(found)
    rows = [(i * 3 + 1, t) for i, t in enumerate(found)]
    assert ours(spark, docs(rows), percent) == brute(rows, percent)


def test_families_in_many_small_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_CLASSES", 7)
    rng = random.Random(8)
    found = [t for edits in (0, 1, 2, 3, 4) for t in family(random.Random(1), 1, 90, 0) + family(rng, 20, 90, edits)]
    base = found[0].split()
    for _ in range(60):  # edits of one text, some of them far from it and near to each other
        copy = list(base)
        for at in rng.sample(range(0, 90, 6), rng.choice([1, 2, 3, 3, 4])):
            copy[at] = f"y{rng.randrange(2)}"
        found.append(" ".join(copy))
    rows = list(enumerate(found))
    expected = brute(rows, 85)
    assert len({c for _, _, c in expected}) > 20
    assert ours(spark, docs(rows)) == expected


def test_chain_links_ends(spark, docs):
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(words[10 * i : 10 * i + 200])) for i in range(8)]
    assert ours(spark, docs(rows)) == brute(rows, 85)
    assert {r[2] for r in ours(spark, docs(rows))} == {0}


def test_nulls_empty_ties_and_long(spark, docs):
    long = " ".join(f"w{i % 5003}" for i in range(200_000))
    rows = [(5, None), (6, ""), (7, " \n"), (9, "a b c d e f"), (9, "a b c d e f"), (8, "A b c d\te F"), (None, "a b c d e f"), (None, "only here without id"), (3, long), (2, long + " end")]
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs(rows)).collect()}
    assert {(5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 2, 8, True), (9, 2, 8, False), (None, 2, 8, False), (None, 1, None, True)} <= found
    assert {(r[0], r[2], r[3]) for r in found if r[0] in (2, 3)} == {(2, 2, True), (3, 2, False)}


def test_empty_table_and_clashing_columns(spark, docs):
    assert minhash.near_duplicates(docs([])).count() == 0
    more = docs([(1, "a b c d e f"), (2, "a b c d e f")]).withColumn("cls", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("row", F.lit(2)).withColumn("text_hash", F.lit(3))
    kept = minhash.first_of_each_group(more)
    assert kept.columns == more.columns and [r.doc_id for r in kept.collect()] == [1]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 2, 40, 3000):
        a = rng.integers(0, 2**63, n, np.uint64)
        assert (minhash.sketch(a) > 0).all() or n == 1
    common, only = rng.integers(0, 2**63, 800, np.uint64), rng.integers(0, 2**63, 400, np.uint64)
    a, b = np.concatenate([common, only[:200]]), np.concatenate([common, only[200:]])
    agree = np.mean([np.mean(minhash.sketch(a ^ np.uint64(s)) == minhash.sketch(b ^ np.uint64(s))) for s in range(20)])
    assert abs(agree - 800 / 1200) < 0.04


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
