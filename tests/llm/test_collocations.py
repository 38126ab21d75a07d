"""Collocations against brute force; transducers against plain counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from mediamix.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string, phrase string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, most=5):
    counts, sizes = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]", piece) if w]
            sizes[lang] += len(words)
            f = counts.setdefault(lang, Counter())
            for i in range(len(words)):
                for m in range(1, min(most, len(words) - i) + 1):
                    f[tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {q[i:j] for q in candidates for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q) and f[q] >= f[q[i:j]]}
        found = []
        for p in candidates - covered:
            score, k = min((1000 * f[p] * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, n, p.decode(), -a, l, r, sizes[lang], -s) for n, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return set(out)


def ours(spark, rows, **options):
    df = spark.createDataFrame([(i, t, lang, "x") for i, (t, lang) in enumerate(rows)], SCHEMA)
    return {tuple(r) for r in collocations.mine(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def rows_of(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "of", "New", "york", "été", "Été", "x\x00y", "a-b", "\U0001d54f", *(f"w{i}" for i in range(40))]
    weights = [30, 10, 20, 8, 8, 5, 5, 3, 3, 3, *([1] * 40)]
    made = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice(["new york city hall of fame", *rng.choices(words, weights, k=4)]) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " "])
        made.append((text, rng.choice(["en", "en", "en", "fr", None, ""])))
    return [*made, (None, "en"), ("", None), (" .\n", "xx"), *made[:50]]


@pytest.mark.parametrize("least, top", [(1, 100_000), (4, 30), (40, 2000)])
def test_against_brute_force(spark, least, top):
    rows = rows_of(least)
    assert ours(spark, rows, least=least, top=top) == brute(rows, least, top)


def test_many_ranges_and_small_shards(spark, monkeypatch):
    rows = rows_of(9)
    monkeypatch.setattr(collocations, "RANGE_WORDS", 500)
    df = spark.createDataFrame([(i, t, lang, "x") for i, (t, lang) in enumerate(rows)], SCHEMA).coalesce(2)
    got = {tuple(r) for r in collocations.mine(df, least=5, top=500).collect()}
    assert got == brute(rows, 5, 500)


def test_shards_are_cut_by_size(monkeypatch):
    monkeypatch.setattr(collocations, "SPLIT_BYTES", 50)
    monkeypatch.setattr(collocations, "SHARD_BYTES", 200)
    import pyarrow as pa

    texts = [(lang, f"a b {i}. c d".encode()) for i in range(60) for lang in ("x", "y", "z")]
    batch = pa.RecordBatch.from_arrays([pa.array([x for x, _ in texts]), pa.array([t for _, t in texts], pa.binary())], names=["lang", "text"])
    found, largest = Counter(), 0

    def use(lang, shard):
        nonlocal largest
        largest = max(largest, shard.whole)
        ids, words, _ = shard.take()
        found.update((lang, words[i]) for i in ids if i)
        return ()

    list(collocations._in_shards([batch], use))
    assert largest <= 200 and found == Counter((lang, w) for lang, t in texts for w in re.findall(rb"[^ .]+", t))


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    rows = rows_of(3, 100)
    want = ours(spark, rows, least=5)
    monkeypatch.setattr(collocations, "_passing", lambda sketched, least: np.full(1 << (collocations.CELL_BITS - 3), 255, np.uint8))
    assert ours(spark, rows, least=5) == want == brute(rows, 5, 2000)


def test_counts_beyond_64_bits(spark):
    rows = [("a b " * 30_000, "en")] * 30
    assert ours(spark, rows, least=800_000) == brute(rows, 800_000, 2000)


def test_no_rows(spark):
    assert ours(spark, []) == set()
    assert ours(spark, [("rare words only", "en"), (None, None)]) == set()


def counted(offsets, arcs):
    out = {}

    def go(state, path):
        for label, weight, target in arcs[offsets[state] : offsets[state + 1]].tolist():
            out[(*path, label)] = weight
            go(target, (*path, label))

    go(len(offsets) - 2, ())
    return out


def test_transducers_count_prefixes_and_share_states():
    rng = random.Random(0)
    grams = Counter(tuple([rng.randint(1, 2), *(rng.randint(3, 9) for _ in range(rng.randint(1, 5)))]) for _ in range(3000))
    order = sorted(grams)
    matrix = np.array([[*g, *([0] * (6 - len(g)))] for g in order])
    offsets, arcs = collocations.build(matrix, np.array([grams[g] for g in order]))
    want = Counter()
    for g, n in grams.items():
        for m in range(1, len(g) + 1):
            want[g[:m]] += n
    assert counted(offsets, arcs) == want
    states = [tuple(map(tuple, arcs[a:b].tolist())) for a, b in zip(offsets, offsets[1:])]
    assert len(set(states)) == len(states) < len(want)


def test_union_sums_and_drops():
    def part(grams):
        labels = sorted({w for g in grams for w in g})
        number = {w: i for i, w in enumerate(labels, collocations.FIRST_WORD)}
        rows = sorted(((2, *(number[w] for w in g)), n) for g, n in grams.items())
        return (*collocations.build(np.array([[*g, *([0] * (6 - len(g)))] for g, _ in rows]), np.array([n for _, n in rows])), [w.encode() for w in labels])

    grams, totals, words = collocations.unite([part({"ab": 3, "abc": 2, "x": 1}), part({"abc": 4, "ba": 9, "x": 1})], 4)
    found = {"".join(words[i - collocations.FIRST_WORD].decode() for i in g[1:] if i): n for g, n in zip(grams.tolist(), totals.tolist()) if g[1]}
    assert found == {"a": 9, "ab": 9, "abc": 6, "b": 9, "ba": 9}
