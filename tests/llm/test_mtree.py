"""M-tree search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediamix.llm import mtree

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every, k=5):
    valid = {(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q, a in valid:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in valid if i != q)[:k]
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(found, 1)}
    return out


def ours(spark, rows, every, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return {tuple(r) for r in mtree.top_k(df, every, **options).select("query_id", "rank", "vec_id", "score").collect()}


def test_clusters_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(mtree, "SLICE", 150)
    monkeypatch.setattr(mtree, "PAGE", 20)
    monkeypatch.setattr(mtree, "FAN", 5)
    monkeypatch.setattr(mtree, "BLOCK", 20)
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (6, 8))
    vectors = [(centres[i % 6] + rng.normal(0, 0.1, 8)).tolist() for i in range(700)] + [[0.25] * 8] * 130 + [[0.0] * 8] * 3
    rows = list(enumerate(vectors))
    assert ours(spark, rows, 10) == brute(rows, 10)


@pytest.mark.parametrize("n", [1, 2, 4])
def test_few_rows(spark, n):
    rows = [(50 * i, [0.1 * i, 1.0]) for i in range(n)]
    assert ours(spark, rows, 50) == brute(rows, 50)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []), (None, [1.0, 1.0]), (6, [-1.0, 3.0]), (8, [1.0, 2.0, 3.0]), (0, [1.0, 2.0])]
    assert ours(spark, rows, 50) == {(0, 1, 6, 65536 * 5)}
    assert ours(spark, [], 50) == set() and ours(spark, [(1, [1.0])], 50) == set()


@pytest.mark.parametrize("all_large", [False, True])
def test_large_components_are_scored_exactly(spark, monkeypatch, all_large):
    monkeypatch.setattr(mtree, "BLOCK", 7)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(150):
        scale = 1e6 if all_large or i % 9 == 0 else 1.0
        rows.append((i, (rng.normal(0, 1, 3) * scale).tolist()))
    rows += [(10, [1e6, -1e6, 3e5]), (10, [1e6, -1e6, 3e5]), (20, [0.5, 1e6, 262144.0])]
    assert ours(spark, rows, 10) == brute(rows, 10)


def test_scores_beyond_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="exceeds 64 bits"):
        ours(spark, [(0, [1e30, 1.0]), (1, [1e30, 1.0]), (2, [0.0, 1.0])], 50)


def test_extra_columns(spark):
    df = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1)], SCHEMA).withColumn("id", F.lit("x")).withColumn("v", F.lit(1)).withColumn("score", F.lit(2))
    assert [tuple(r) for r in mtree.top_k(df, 50).collect()] == [(0, 1, 1, 131072)]


def test_pages_are_skipped(monkeypatch):
    monkeypatch.setattr(mtree, "PAGE", 48)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 300, (20, 16))
    vectors = np.floor(centres[np.arange(4000) % 20] + rng.normal(0, 3, (4000, 16))).astype(np.int64)
    norm = float(np.sqrt((vectors**2).sum(1).max()))
    tree = mtree.Tree(np.arange(4000), vectors, norm)
    seen = []

    class Counting(list):
        def __getitem__(self, at):
            seen.append(at)
            return super().__getitem__(at)

    tree.pages = Counting(tree.pages)
    scores = vectors @ vectors[7]
    expected = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if i != 7))[:5]
    assert [(-s, i) for s, i in tree.search(vectors[7], 7, 5, None)] == expected
    assert len(seen) < len(list.__iter__(tree.pages).__reduce__()[1][0]) / 3
