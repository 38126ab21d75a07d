"""Exact top-k search by inner product over M-trees.

Vectors get one more component so that all have the largest norm R of the table; then
|q - x|^2 = |q|^2 + R^2 - 2 <q, x>, and the highest inner products are the nearest
neighbours in a metric space. A bounded sample gives pivots; every vector goes to the cell
of its nearest pivot, and large cells are cut into slices of bounded size. Each slice is
one M-tree: paged nodes whose entries store a covering radius and the distance to their
node's pivot. A query walks the pages best first. Stored distances and the triangle
inequality rule out entries before their distance is computed, and pages by their radius.
Scores are exact integers; bounds are floating point with a margin, so that they never
rule out a tie. Vectors too large for 64-bit products are scored apart.
"""

from __future__ import annotations

import heapq
import operator
import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediamix.llm.common import map_batches
from mediamix.session import cut_lineage, release

#: Bounds: vectors of a slice, of a page, pivots of a page, queries of a block, sampled rows.
SLICE, PAGE, FAN, BLOCK, SAMPLE = 8192, 512, 16, 4096, 1024
#: Components are less than this, so that inner products stay exact in 64 bits.
LARGEST = 1 << 26
MARGIN = 1e-7


class Tree:
    """M-tree over integer vectors of a slice, bulk-loaded from the top."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float):
        self.ids, self.vectors, self.norm = ids, vectors, norm
        #: page -> ("leaf", rows, distances to the page's pivot) or
        #: ("inner", pivot rows, radii, distances to the page's pivot, child pages)
        self.pages: list[tuple] = []
        self.float = vectors.astype(np.float64)
        self.rest = np.sqrt(np.maximum(norm**2 - (self.float**2).sum(1), 0))
        pivot = int(np.argmin(((self.float - self.float.mean(0)) ** 2).sum(1)))
        everything = np.arange(len(ids))
        self.pivot, distances = pivot, self._distances(pivot, everything)
        self.radius = float(distances.max())
        self.root = self._load(everything, distances, np.random.default_rng(1))
        # inner products of less than 2^52 are exact in floating point, too, and faster there
        self.vectors = self.float if norm**2 < 2.0**52 else vectors
        del self.float, self.rest

    def _distances(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.float[rows] - self.float[pivot]) ** 2).sum(1) + (self.rest[rows] - self.rest[pivot]) ** 2)

    def _load(self, rows: np.ndarray, to_pivot: np.ndarray, rng: np.random.Generator) -> int:
        if len(rows) <= PAGE:
            self.pages.append(("leaf", rows, to_pivot))
            return len(self.pages) - 1
        pivots = rng.choice(len(rows), FAN, replace=False)
        distances = np.stack([self._distances(int(rows[p]), rows) for p in pivots])
        nearest = distances.argmin(0)
        if (np.bincount(nearest, minlength=FAN) == len(rows)).any():  # equal vectors: any split will do
            nearest = np.arange(len(rows)) % FAN
        entries = []
        for i, p in enumerate(pivots):
            own = np.flatnonzero(nearest == i)
            if len(own):
                near = distances[i, own]
                entries.append((int(rows[p]), float(near.max()), float(to_pivot[p]), self._load(rows[own], near, rng)))
        rows_, radii, parents, children = zip(*entries)
        self.pages.append(("inner", np.array(rows_), np.array(radii), np.array(parents), list(children)))
        return len(self.pages) - 1

    def search(self, query: np.ndarray, own: int, k: int, least: int | None) -> list[tuple[int, int]]:
        """Up to k (score, id) by descending score and ascending id, of rows not called ``own``.

        Rows that score below ``least`` may be left out.
        """
        exact = query.astype(self.vectors.dtype)
        total = float((query.astype(np.float64) ** 2).sum()) + self.norm**2
        margin = MARGIN * (self.norm + 1)
        best: list[tuple[int, int]] = []

        def far(score: int | None) -> float:
            return np.inf if score is None else np.sqrt(max(total - 2.0 * score, 0)) + margin

        def distance(rows: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(total - 2.0 * (self.vectors[rows] @ exact), 0))

        reach = far(least)
        start = float(distance(np.array([self.pivot]))[0])
        queue = [(max(start - self.radius, 0), 0, self.root, start)]
        pushed = 1
        while queue:
            bound, _, page, to_page = heapq.heappop(queue)
            if bound > reach:
                break
            kind, rows, *stored = self.pages[page]
            if kind == "inner":
                radii, parents, children = stored
                hope = np.flatnonzero(np.abs(to_page - parents) - radii <= reach)
                if len(hope):
                    distances = distance(rows[hope])
                    for i, d in zip(hope.tolist(), distances.tolist()):
                        if d - radii[i] <= reach:
                            heapq.heappush(queue, (max(d - radii[i], 0), pushed, children[i], d))
                            pushed += 1
                continue
            rows = rows[np.abs(to_page - stored[0]) <= reach]
            if len(rows):
                scores, ids = (self.vectors[rows] @ exact).astype(np.int64), self.ids[rows]
                good = ids != own
                if len(best) == k:
                    good &= scores >= best[-1][0]
                if good.any():
                    best += zip(scores[good].tolist(), ids[good].tolist())
                    best = sorted(best, key=lambda b: (-b[0], b[1]))[:k]
                    if len(best) == k:
                        reach = min(reach, far(best[-1][0]))
        return best


def whole_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, w, large): floor(``scale`` * x) of every component as doubles, of the vectors that take part.

    Left out: null ids; vectors that are null, empty, or hold a null or non-finite
    component; vectors of another length than the most frequent one (the shorter, if tied),
    as they have no product with it. ``large`` marks those with a component of ``LARGEST``
    or more after scaling. Rows that agree in id and vector count once.
    """
    numbers = F.col(vector).cast("array<double>")
    scaled = F.transform(numbers, lambda x: F.when(F.abs(x * scale) < 2.0**52, F.floor(x * scale).cast("double")).otherwise(x * scale))
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col(key).isNotNull() & (F.size(vector) > 0) & finite
    large = F.exists("w", lambda x: F.abs(x) >= LARGEST)
    whole = rows.where(F.coalesce(good, F.lit(False))).select(F.col(key).cast("bigint").alias("id"), scaled.alias("w")).withColumn("large", large)
    length = whole.groupBy(F.size("w").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return whole.where(F.size("w") == (length[0]["n"] if length else 0)).distinct()


def build(vectors: DataFrame, sampled: np.ndarray, norm: float, n: int) -> DataFrame:
    """(cell, part, tree): M-trees of slices of at most about ``SLICE`` vectors."""
    pivots = sampled[: max(1, min(len(sampled), n // SLICE))].astype(np.float64)

    def make() -> Callable[[dict], dict]:
        def run(columns: dict) -> dict:
            v = np.array(columns["v"], np.float64)
            rest = np.sqrt(np.maximum(norm**2 - (v**2).sum(1), 0))
            high = np.sqrt(np.maximum(norm**2 - (pivots**2).sum(1), 0))
            near = v @ pivots.T + np.outer(rest, high)
            return {"id": columns["id"], "v": columns["v"], "cell": near.argmax(1).tolist()}

        return run

    cells = cut_lineage(map_batches(vectors, make, "id bigint, v array<int>, cell int"))
    parts = cells.groupBy("cell").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("parts"))  # as many rows as pivots
    placed = cells.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int"))

    def load(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        tree = Tree(np.array(group["id"], np.int64), np.array(group["v"].to_pylist(), np.int64), norm)
        first = group.slice(0, 1)
        return pa.table({"cell": first["cell"], "part": first["part"], "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    trees = cut_lineage(placed.groupBy("cell", "part").applyInArrow(load, "cell int, part int, tree binary"))
    release(cells)
    return trees


def top_k(rows: DataFrame, every: int, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """The ``k`` rows of the highest integer inner product with each query; see ``whole_vectors``.

    Queries are the rows whose id is divisible by ``every``. Candidates are all rows that take part,
    but those of the query's id. Returns ``query_id``, ``rank`` (from 1), the found ``key``
    and ``score``; ties go to the smaller id. Rows of one id but different vectors are
    queries and candidates of their own, so their ranks repeat. Fewer than ``k`` candidates
    give fewer rows; without queries or candidates the result is empty.

    Queries go in blocks of bounded size, each sent to all slices; a seed bound from the
    sampled rows prunes from the first page on. Results of a block are at most k rows for
    each query and slice. Vectors with a component too large for exact 64-bit products are
    few, if any; pairs with one of them are scored in Python's integers instead of the trees,
    and a score of the result that 64 bits cannot hold is an error.
    """
    every_vector = cut_lineage(whole_vectors(rows, key, vector, scale))
    vectors = cut_lineage(every_vector.where("NOT large").select("id", F.col("w").cast("array<int>").alias("v")))
    measured = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint") * x)
    n, largest = vectors.agg(F.count("*"), F.max(measured)).collect()[0]
    norm = float(np.sqrt(largest or 0))
    taken = [(r.id, r.v) for r in vectors.orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).collect()]
    empty = rows.sparkSession.createDataFrame([], f"query_id bigint, rank int, {key} bigint, score bigint")
    large = every_vector.where("large")
    beyond = [] if large.isEmpty() else _scored_apart(every_vector, every, k)
    if not n and not beyond:
        return empty
    seed_ids, seeds = np.array([i for i, _ in taken], np.int64), np.array([v for _, v in taken], np.int64)
    trees = build(vectors, seeds, norm, n) if n else None
    asked = vectors.where(F.col("id") % every == 0)
    blocks = -(-asked.count() // BLOCK)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(max(1, blocks))))
    results = []
    for block in range(blocks):
        some = sorted((r.id, r.v) for r in asked.where(F.col("block") == block).select("id", "v").collect())
        ids, wanted = [i for i, _ in some], np.array([v for _, v in some], np.int64)
        least = []
        for own, q in zip(ids, wanted):
            scores = (seeds @ q)[seed_ids != own]
            least.append(int(np.partition(scores, -k)[-k]) if len(scores) >= k else None)
        results.append(cut_lineage(_search(trees, block, ids, wanted, least, k)))
    results += beyond
    release(vectors, every_vector)
    if not results:
        return empty
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")


def label_of(vector: np.ndarray) -> str:
    """Tells apart the vectors of queries of one id."""
    return xxhash.xxh3_128_hexdigest(np.asarray(vector, np.float64).tobytes())


def _scored_apart(vectors: DataFrame, every: int, k: int) -> list[DataFrame]:
    """The k best of every pair that has a large vector, for each query and batch of rows.

    Blocks of large queries meet all rows, and blocks of large candidates the other queries.
    """
    large = vectors.where("large").withColumn("block", F.xxhash64("id", "w"))
    is_query = F.col("id") % every == 0
    out = []
    for fixed, rows, queries in ((large.where(is_query), vectors, True), (large, vectors.where(is_query & ~F.col("large")), False)):
        blocks = -(-fixed.count() // BLOCK)
        for block in range(blocks):
            some = fixed.where(F.pmod("block", F.lit(blocks)) == block).select("id", "w").collect()
            out.append(cut_lineage(_exact(rows, [(r.id, r.w) for r in some], queries, k)))
    return out


def _exact(rows: DataFrame, fixed: list[tuple[int, list[float]]], queries: bool, k: int) -> DataFrame:
    """(query_id, query, id, score) of ``fixed`` vectors, which are ``queries`` or candidates, and the rows."""

    def make() -> Callable[[dict], dict]:
        own = [(i, [int(x) for x in w], label_of(w)) for i, w in fixed]

        def run(columns: dict) -> dict:
            met = [(i, [int(x) for x in w], label_of(w)) for i, w in zip(columns["id"], columns["w"])]
            out: dict = {"query_id": [], "query": [], "id": [], "score": []}
            for query_id, query, label in own if queries else met:
                scores = sorted((-sum(map(operator.mul, query, v)), i) for i, v, _ in (met if queries else own) if i != query_id)[:k]
                for score, found in scores:
                    if not -(2**63) < score < 2**63:
                        raise ValueError(f"the product of {query_id} and {found} exceeds 64 bits")
                    for name, value in zip(out, (query_id, f"{query_id}/{label}", found, -score)):
                        out[name].append(value)
            return out

        return run

    return map_batches(rows.select("id", "w"), make, "query_id bigint, query string, id bigint, score bigint")


def _search(trees: DataFrame, block: int, ids: list[int], wanted: np.ndarray, least: list, k: int) -> DataFrame:
    """(query_id, query, id, score) of one block of queries in every slice."""

    def make() -> Callable[[dict], dict]:
        labels = [label_of(v) for v in wanted]

        def run(columns: dict) -> dict:
            out: dict = {"query_id": [], "query": [], "id": [], "score": []}
            for data in columns["tree"]:
                tree = pickle.loads(data)
                for n, own in enumerate(ids):
                    for score, found in tree.search(wanted[n], own, k, least[n]):
                        for name, value in zip(out, (own, f"{own}/{labels[n]}", found, score)):
                            out[name].append(value)
            return out

        return run

    return map_batches(trees.select("tree"), make, "query_id bigint, query string, id bigint, score bigint")
