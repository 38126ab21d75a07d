"""Near-duplicates by fast similarity sketching, banding and exact verification.

The sketch of a set has ``COORDINATES`` places. In round i every element is hashed to one
place with a value that starts with i; a place keeps the least it gets. Rounds go on until
no place is empty; the last ``COORDINATES`` of at most twice as many rounds send all
elements to one place each, so every place fills. Two sets agree in a place with
probability equal to their similarity, and the share of places that agree is concentrated
as for independent hashes, at a cost of about n + t log t instead of n * t.

Documents of equal sets are one class. Classes that agree in a whole band of places are
candidates; a candidate pair is linked only if the full sets are similar enough.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.llm.common import apart, map_batches, row_key, same_row, type_of, whole_text
from mediamix.llm.components import components
from mediamix.session import cut_lineage, release

WORDS = 5
#: 30 bands of 5 places: a pair of similarity 0.85 shares no band with probability 2e-8, one
#: of 0.8 with 7e-6.
BANDS, ROWS = 30, 5
COORDINATES = BANDS * ROWS
REMEMBERED = 500_000
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; one for the whole of a shorter text.

    Words are what stands between ASCII white space, A-Z in lower case.
    """
    words = text.encode().lower().split()  # of bytes: both concern ASCII only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(h) < WORDS:
        return mix((h * ODD[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - WORDS + 1
    total = h[:n] * ODD[0]
    for k in range(1, WORDS):
        total += h[k : k + n] * ODD[k]
    return np.unique(mix(total + np.uint64(WORDS)))


def sketch(elements: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of a set that is not empty."""
    out = np.zeros(coordinates, np.uint64)
    empty = np.ones(coordinates, bool)
    low = np.uint64((1 << 40) - 1)
    none = np.iinfo(np.uint64).max
    for i in range(2 * coordinates):
        h = mix(elements + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & none))
        if i < coordinates:
            found = np.full(coordinates, none, np.uint64)
            np.minimum.at(found, ((h >> np.uint64(40)) % np.uint64(coordinates)).astype(np.intp), h & low)
            fill = empty & (found != none)
            out[fill] = found[fill] | np.uint64(i << 40)
            empty &= ~fill
            if not empty.any():
                break
        elif empty[i - coordinates]:
            out[i - coordinates] = (h & low).min() | np.uint64(i << 40)
    return out


def band_keys(places: np.ndarray) -> np.ndarray:
    """One key for each band of places."""
    rows = places.reshape(BANDS, ROWS)
    return mix((mix(rows) * ODD[:ROWS]).sum(axis=1) + np.arange(1, BANDS + 1, dtype=np.uint64))


def _described(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, n, cls, bands) per document; ``cls`` and ``bands`` are null without words."""

    def make():
        hashes = WordHashes()

        def run(columns: dict) -> dict:
            sets = [shingles(t, hashes) for t in columns["text"]]
            return {
                "id": columns["id"],
                "text_hash": columns["text_hash"],
                "n": [len(s) for s in sets],
                "cls": [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets],
                "bands": [band_keys(sketch(s)).view(np.int64).tolist() if len(s) else None for s in sets],
            }

        return run

    plain = docs.select(row_key(key, text).alias("row"), whole_text(text).alias("text")).select("row.*", "text")
    return map_batches(plain, make, f"id {type_of(docs, key)}, text_hash bigint, n bigint, cls binary, bands array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(cls, elements) of the ``wanted`` (cls, id, text_hash)."""

    def make():
        hashes = WordHashes()

        def run(columns: dict) -> dict:
            return {"cls": columns["cls"], "elements": [np.sort(shingles(t, hashes).view(np.int64)).tolist() for t in columns["text"]]}

        return run

    plain = docs.select(row_key(key, text).alias("row"), whole_text(text).alias("text")).select("row.*", "text")
    found = plain.join(wanted, plain["id"].eqNullSafe(wanted["id"]) & (plain["text_hash"] == wanted["text_hash"]))
    return map_batches(found.select("cls", "text"), make, "cls binary, elements array<bigint>")


#: Classes and set elements of a block of members that are compared with a block of others.
BLOCK_CLASSES, BLOCK_ELEMENTS = 256, 1 << 20


def _renamed(roots: DataFrame, merged: DataFrame) -> DataFrame:
    """(node, root) with the roots that ``merged`` (node, root) maps to others."""
    return roots.join(merged.toDF("root", "least"), "root", "left").select("node", F.coalesce("least", "root").alias("root"))


def _links_within_families(star: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between roots that share a bucket and have not been joined by its hub.

    The family of a hub holds all members of its buckets that still have several roots, so
    any two members of such a bucket are in one family. Those of the family's commonest root
    need no comparison among themselves; the rest is compared with the whole family.
    """
    rooted = star.join(roots, star["cls"] == roots["node"]).drop("node")
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("bucket")
    family = cut_lineage(rooted.join(mixed, "bucket", "left_semi").select("hub", "cls", "n", "root").distinct())
    common = family.groupBy("hub", "root").agg(F.count("*").alias("n")).groupBy("hub").agg(F.max(F.struct("n", "root")).alias("most"))
    other = F.when(F.col("root") != F.col("most.root"), 1).otherwise(0)
    counted = family.join(common, "hub").withColumn("other", other)
    blocks = counted.groupBy("hub").agg(
        *(F.ceil(F.greatest(count / BLOCK_CLASSES, weight / BLOCK_ELEMENTS)).cast("int").alias(name) for name, count, weight in (("all_blocks", F.count("*"), F.sum("n")), ("other_blocks", F.sum("other"), F.sum(F.col("n") * F.col("other")))))
    )
    placed = counted.join(blocks, "hub").join(sets, "cls").select("hub", "other", "all_blocks", "other_blocks", "root", "elements", F.xxhash64("cls").alias("h"))

    def side(rows: DataFrame, own: str, across: str) -> DataFrame:
        """Each row in its own block, for every block of the other side."""
        at = F.pmod("h", own).cast("int").alias(own)
        return rows.select("hub", at, F.explode(F.sequence(F.lit(0), F.col(across) - 1)).alias(across), "root", "elements").select("hub", "other_blocks", "all_blocks", "root", "elements")

    keys = ("hub", "other_blocks", "all_blocks")
    one = side(placed.where("other = 1"), "other_blocks", "all_blocks").groupBy(*keys)
    every = side(placed, "all_blocks", "other_blocks")
    every = every.select(*(F.col(c).alias(f"{c}_") for c in every.columns)).toDF(*every.columns).groupBy(*keys)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            for x, y in linking_pairs(left["root"].to_pylist(), _arrays(left), right["root"].to_pylist(), _arrays(right), percent):
                a.append(x)
                b.append(y)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return one.cogroup(every).applyInArrow(compare, "a binary, b binary")


def _arrays(table: pa.Table) -> list[np.ndarray]:
    column = table["elements"].combine_chunks()
    ends, values = np.asarray(column.offsets), np.asarray(column.values)
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def linking_pairs(roots_a: list[bytes], sets_a: list[np.ndarray], roots_b: list[bytes], sets_b: list[np.ndarray], percent: int) -> list[tuple[bytes, bytes]]:
    """Links between the sets of two blocks that join different roots; a forest of them."""
    up: dict[bytes, bytes] = {}

    def find(r: bytes) -> bytes:
        while (above := up.get(r, r)) != r:
            r = above
        return r

    out = []
    sizes = np.array([len(s) for s in sets_b])
    flat, owner = np.concatenate(sets_b), np.repeat(np.arange(len(sets_b)), sizes)
    for root, elements in zip(roots_a, sets_a):
        at = np.searchsorted(elements, flat)
        at[at == len(elements)] = 0
        common = np.bincount(owner[elements[at] == flat], minlength=len(sets_b))
        for i in np.flatnonzero(100 * common >= percent * (sizes + len(elements) - common)).tolist():
            x, y = find(root), find(roots_b[i])
            if x != y:
                up[max(x, y)] = min(x, y)
                out.append((root, roots_b[i]))
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """Groups of documents linked by similar shingle sets, directly or through others.

    Links hold where 100 * |intersection| >= ``percent`` * |union|. Returns per document:
    ``key``, ``text_hash``, ``n_shingles``, ``component_id`` (smallest id of its group),
    ``kept`` (it has that id). A null or empty text, or one without words, has an empty set
    and is a group of its own. A null id never is the smallest; a group without any id has
    the component null and keeps the rows of one class. Rows that agree in id and text are
    one document and stay or go together. Other columns are not read. An empty table gives
    an empty result.

    Copies are never expanded to pairs. The class of a bucket that shares most bands with
    others is its hub, and every member is compared with it. Where that leaves a bucket
    with several groups, the members outside the largest group are compared with all others
    of the hub's family, block by block inside tasks of bounded size; only the links that
    join groups come out. So no pair is left out for a bucket's size, and none is a row.
    """
    described = cut_lineage(_described(docs, key, text))
    classes = cut_lineage(
        described.where("cls IS NOT NULL")
        .groupBy("cls")
        .agg(F.min("id").alias("least_id"), F.min(F.struct("id", "text_hash")).alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    )
    in_bands = classes.select("cls", "n", F.explode("bands").alias("bucket"))
    buckets = in_bands.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = in_bands.join(buckets, "bucket")
    popular = shared.groupBy("cls").agg(F.sum("members").alias("popular"))
    shared = cut_lineage(shared.drop("members").join(popular, "cls"))
    nodes = shared.select("cls").distinct()
    sets = cut_lineage(_sets(docs, classes.select("cls", "row.*").join(nodes, "cls", "left_semi"), key, text))

    best = shared.groupBy("bucket").agg(F.max(F.struct("popular", "cls", "n")).alias("hub"))
    star = shared.join(best, "bucket").select("bucket", "cls", "n", F.col("hub.cls").alias("hub"), F.col("hub.n").alias("hub_n"))
    star = cut_lineage(star)
    near = f"100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)"
    pairs = star.where(f"cls <> hub AND {near}").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    linked = cut_lineage(both.where(f"100 * common >= {percent} * (size(x) + size(y) - common)").select("a", "b"))
    roots = cut_lineage(_renamed(nodes.select(F.col("cls").alias("node"), F.col("cls").alias("root")), components(linked)))
    more = cut_lineage(_links_within_families(star, roots, sets, percent))
    final = cut_lineage(_renamed(roots, components(more)))
    release(shared, linked, roots, more, star, sets)
    roots = final

    grouped = classes.select("cls", "least_id").join(roots, F.col("cls") == F.col("node"), "left").select("cls", "least_id", F.coalesce("root", "cls").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"), F.min("cls").alias("first_cls"))
    named = grouped.select("cls", "root").join(least, "root").select("cls", "component_id", "first_cls")
    out = described.select("id", "text_hash", "n", "cls").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component_id"))
    alone = F.coalesce(F.col("id").isNull() & F.col("component_id").isNull() & (F.col("cls") == F.col("first_cls")), F.lit(False))
    kept = F.col("cls").isNull() | F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)) | alone
    return out.select(F.col("id").alias(key), "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def first_of_each_group(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The documents that stand for their group; columns as they were."""
    found = near_duplicates(docs, key, text, percent)
    gone = apart(docs, found.where("NOT kept").select(key, "text_hash").distinct())
    return docs.join(gone, same_row(docs, gone, key, text), "left_anti")
