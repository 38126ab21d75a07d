"""Phrase collocation mining over weighted acyclic automata.

1. A sketch of fixed size counts words and pairs of neighbours by hash. A cell is never
   below the count of what falls into it, so a phrase with a word or pair in a cell below
   the threshold cannot be a candidate. Where the sketch is full it rules out less; the
   result is the same.
2. Tasks cut texts into shards of bounded size. A shard's n-grams (one window of up to five
   words for each place) are sorted and built into count transducers, one for each range of
   two-word prefixes: n-grams come in order, states that no later n-gram can reach are
   frozen, and equal frozen states are shared. The weight of an arc is the number of windows
   that pass it, which is the count of the phrase read so far.
3. The transducers of a range are united from the root on, weights of equal arcs summed,
   and arcs below the threshold dropped with all below them, as no phrase there can count.
4. Parts of candidates are composed with the transducer of the range that owns their prefix,
   which gives their counts; scores and ranks are plain columns.

The prefix is two words, so a word that a third of all windows begin with is spread over all
ranges, and a passage that stands in very many documents is one path in each shard.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediamix.llm.common import whole_text
from mediamix.session import cut_lineage, release

#: Contract values: words of a phrase, least count of a candidate, reported phrases of a language.
WORDS, LEAST, TOP = 5, 100, 2000
#: Language of documents without one.
UNKNOWN = "und"
#: Cells of the sketch, one byte each, and cells sent together.
CELL_BITS, CHUNK_BITS = 24, 16
#: Bytes of text split at a time, and bytes of all shards that a task holds.
SPLIT_BYTES, SHARD_BYTES = 4 << 20, 12 << 20
#: Words of the corpus for each prefix range.
RANGE_WORDS = 4_000_000
#: Languages that a task holds shards of at a time.
LANGUAGES = 256
#: Partial rankings of a language.
SALT = 32

_LOWER = bytes(range(65, 91))
_PARTS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_LOWER + _PARTS + b"\t", _LOWER.lower() + b"\n" * len(_PARTS) + b" ")
#: Odd multipliers that mix hashes of neighbouring words.
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


class Shard:
    """Word numbers of texts of one language; number 0 stands between pieces."""

    def __init__(self, lang: str):
        self.seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        self.held: list[bytes] = []
        self.size = 0
        self.clear()

    def clear(self) -> None:
        self.whole = 0
        self.numbers: defaultdict[bytes, int] = defaultdict(count(2).__next__)
        self.numbers[b"\n"], self.numbers[b""] = 0, 1
        self.runs: list[np.ndarray] = []

    def add(self, text: bytes) -> None:
        self.held.append(text.translate(_TABLE))
        self.size += len(text)
        self.whole += len(text)
        if self.size >= SPLIT_BYTES:
            self.split()

    def split(self) -> None:
        if self.held:
            parts = b"\n".join(self.held).replace(b"\n", b" \n ").split(b" ")
            ids = np.fromiter(map(self.numbers.__getitem__, parts), np.int32, len(parts))
            ids = ids[ids != 1]
            self.runs += [ids, np.zeros(1, np.int32)]
            self.held, self.size = [], 0

    def take(self) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Word numbers, words and their hashes; the shard is empty afterwards."""
        self.split()
        ids = np.concatenate([*self.runs, np.zeros(1, np.int32)])
        words = list(self.numbers)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) ^ self.seed
        self.clear()
        return ids, words, hashes


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * _MIX[1] + (second ^ (second >> np.uint64(29))) * _MIX[2]
    return (mixed ^ (mixed >> np.uint64(32))) * _MIX[0]


def _span(ranges: int) -> np.uint64:
    """Width of a range of hashes."""
    return np.uint64(min(2**64 - 1, 2**64 // ranges + 1))


def _cell(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _MIX[0]) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _in_shards(batches: Iterator[pa.RecordBatch], use) -> Iterator:
    """``use(lang, shard)`` for shards of bounded size of (lang, text as bytes) rows."""
    shards: dict[str, Shard] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            if lang not in shards:
                shards[lang] = Shard(lang)
            shards[lang].add(text)
            held += len(text)
            while held >= SHARD_BYTES or len(shards) > LANGUAGES:
                largest = max(shards, key=lambda name: shards[name].whole)
                held -= shards[largest].whole
                yield from use(largest, shards.pop(largest))
    for lang, shard in shards.items():
        yield from use(lang, shard)


def _sketched(texts: DataFrame) -> DataFrame:
    """Per task: (lang, n) word counts, and (chunk, cells) of the sketch."""
    schema = pa.schema([("lang", pa.string()), ("n", pa.int64()), ("chunk", pa.int32()), ("cells", pa.binary())])

    def run(batches):
        cells = np.zeros(1 << CELL_BITS, np.uint8)
        totals: defaultdict[str, int] = defaultdict(int)

        def use(lang, shard):
            ids, _, hashes = shard.take()
            totals[lang] += int((ids > 0).sum())
            own = hashes[ids]
            one = own[ids > 0]
            both = (ids[:-1] > 0) & (ids[1:] > 0)
            for found in (_cell(one), _cell(_pair(own[:-1][both], own[1:][both]))):
                at, times = np.unique(found, return_counts=True)
                cells[at] = np.minimum(cells[at] + times, 255)
            return ()

        for _ in _in_shards(batches, use):
            pass
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals)), pa.array(list(totals.values()), pa.int64()), pa.nulls(len(totals), pa.int32()), pa.nulls(len(totals), pa.binary())], schema=schema)
            for chunk, part in enumerate(cells.reshape(-1, 1 << CHUNK_BITS)):
                if part.any():
                    data = zlib.compress(part.tobytes(), 1)
                    yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([chunk], pa.int32()), pa.array([data], pa.binary())], schema=schema)

    return texts.mapInArrow(run, "lang string, n bigint, chunk int, cells binary")


def _passing(sketched: DataFrame, least: int) -> np.ndarray:
    """Bits of the cells that reach ``least`` in all, 2**CELL_BITS of them."""
    bound = min(least, 255)

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(zlib.decompress(data.as_py()), np.uint8)
                total = sums.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.uint16))
                np.minimum(total + part, 255, out=total)
        for chunk, total in sums.items():
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "bits": pa.array([np.packbits(total >= bound).tobytes()], pa.binary())})

    chunks = sketched.where("chunk IS NOT NULL").select("chunk", "cells").repartition(min(1 << (CELL_BITS - CHUNK_BITS), 32), "chunk")
    bits = np.zeros((1 << (CELL_BITS - CHUNK_BITS), 1 << (CHUNK_BITS - 3)), np.uint8)
    for row in chunks.mapInArrow(run, "chunk int, bits binary").collect():  # 2 MB at most
        bits[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.reshape(-1)


def build(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimal count transducer of sorted distinct n-grams, built incrementally.

    ``grams`` is a matrix of labels above 0, ended by zeros, sorted by row. Returns
    ``offsets`` of states and their ``arcs`` (label, weight, target) in order; the last
    state is the root, state 0 has no arcs.
    """
    n, width = grams.shape
    lengths = (grams > 0).sum(1)
    shared = np.zeros(n + 1, np.int64)
    if n > 1:
        same = np.logical_and.accumulate(grams[1:] == grams[:-1], axis=1).sum(1)
        shared[1:n] = np.minimum(same, np.minimum(lengths[1:], lengths[:-1]))
    register: dict[tuple, int] = {(): 0}
    path: list[list[int]] = [[] for _ in range(width + 1)]  # arcs of the open states
    below = [0] * (width + 1)  # windows that pass the open arc to each depth
    rows, sizes, times, ahead = grams.tolist(), lengths.tolist(), counts.tolist(), shared[1:].tolist()
    for row, size, weight, keep in zip(rows, sizes, times, ahead):
        below[size] += weight
        for depth in range(size, keep, -1):  # the next n-gram leaves these states
            arcs = path[depth]
            key = tuple(arcs)
            state = register.get(key)
            if state is None:
                state = register[key] = len(register)
            arcs.clear()
            passed = below[depth]
            path[depth - 1] += (row[depth - 1], passed, state)
            below[depth] = 0
            below[depth - 1] += passed
    states = [*register, tuple(path[0])]
    flat = np.fromiter((x for s in states for x in s), np.int64)
    offsets = np.cumsum([0, *(len(s) // 3 for s in states)])
    return offsets, flat.reshape(-1, 3)


def _packed(offsets: np.ndarray, arcs: np.ndarray, words: list[bytes]) -> bytes:
    """One transducer and the words of its labels (label 2 and on) as bytes."""
    text = b" ".join(words)
    kind = "<i8" if arcs.size and arcs.max() > 2**31 - 1 else "<i4"
    head = np.array([len(offsets), len(arcs), len(text), len(words), kind == "<i8"], "<i8").tobytes()
    return zlib.compress(head + offsets.astype("<i8").tobytes() + arcs.T.astype(kind).tobytes() + text, 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    data = zlib.decompress(data)
    states, n, size, n_words, wide = np.frombuffer(data, "<i8", 5).tolist()
    offsets = np.frombuffer(data, "<i8", states, 40)
    at = 40 + 8 * states
    arcs = np.frombuffer(data, "<i8" if wide else "<i4", 3 * n, at).reshape(3, n).T.astype(np.int64)
    return offsets, arcs, data[len(data) - size :].split(b" ") if n_words else []


#: First labels: words alone, phrases. Labels of words follow.
ALONE, PHRASE, FIRST_WORD = 1, 2, 3


def _transducers(lang: str, shard: Shard, bits: np.ndarray, ranges: int, words_most: int) -> Iterator[tuple[str, int, bytes]]:
    """(lang, range, transducer) of the n-grams of a shard that the sketch lets pass."""
    ids, words, hashes = shard.take()
    own = hashes[ids]
    cell = _cell(hashes)
    passes = ((bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1).astype(bool)
    passes[:2] = False
    good = passes[ids]
    pair_hash = _pair(own[:-1], own[1:])
    cell = _cell(pair_hash)
    linked = good[:-1] & good[1:] & (((bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1) > 0)
    used = np.flatnonzero(np.bincount(ids[good], minlength=len(words)))
    if not len(used):
        return
    label = np.zeros(len(words), np.int64)
    label[used] = np.arange(len(used))
    span = _span(ranges)
    # words alone
    times = np.bincount(label[ids[good]], minlength=len(used))
    grams = np.zeros((len(used), words_most + 1), np.int64)
    grams[:, 0], grams[:, 1] = ALONE, np.arange(len(used)) + FIRST_WORD
    place = (hashes[used] * _MIX[0]) // span
    # phrases: windows of linked words, as long as they go
    at = np.flatnonzero(linked)
    more = np.zeros((len(at), words_most + 1), np.int64)
    more[:, 0], more[:, 1], more[:, 2] = PHRASE, label[ids[at]] + FIRST_WORD, label[ids[at + 1]] + FIRST_WORD
    going, padded = np.ones(len(at), bool), np.concatenate([linked, np.zeros(words_most, bool)])
    ids = np.concatenate([ids, np.zeros(words_most, np.int32)])
    for step in range(2, words_most):
        going &= padded[at + step - 1]
        more[:, step + 1] = np.where(going, label[ids[at + step]] + FIRST_WORD, 0)
    bits_of = int(len(used) + FIRST_WORD).bit_length()
    keys, left = [], 64
    for column in range(1, words_most + 1):  # as few sort keys as hold all columns
        if left + bits_of > 63:
            keys.append(more[:, column])
            left = bits_of
        else:
            keys[-1] = (keys[-1] << bits_of) | more[:, column]
            left += bits_of
    pairs = pair_hash[at] // span
    order = np.lexsort((*reversed(keys), pairs))
    more, pairs = more[order], pairs[order]
    if len(more):
        new = np.concatenate([[True], (more[1:] != more[:-1]).any(1)])
        starts = np.flatnonzero(new)
        sums = np.diff(np.concatenate([starts, [len(more)]]))
        more, pairs = more[starts], pairs[starts]
    else:
        sums = np.zeros(0, np.int64)
    by_place = np.argsort(place, kind="stable")
    grams, times, place = grams[by_place], times[by_place], place[by_place]
    for number in np.union1d(place, pairs):
        a, b = np.searchsorted(place, [number, number + np.uint64(1)])
        c, d = np.searchsorted(pairs, [number, number + np.uint64(1)])
        both, weights = np.concatenate([grams[a:b], more[c:d]]), np.concatenate([times[a:b], sums[c:d]])
        inside = np.unique(both[:, 1:])
        inside = inside[inside >= FIRST_WORD]
        dense = np.zeros(len(used) + FIRST_WORD, np.int64)
        dense[inside] = np.arange(len(inside)) + FIRST_WORD
        both[:, 1:] = dense[both[:, 1:]]  # keeps the order
        yield lang, int(number), _packed(*build(both, weights), [words[used[i - FIRST_WORD]] for i in inside])


def unite(parts: list[tuple[np.ndarray, np.ndarray, list[bytes]]], least: int, words_most: int = WORDS) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Sum of transducers without what is below ``least``: n-grams, their counts, words.

    Works from the root on: a state of the sum is a set of states of the parts, an arc the
    sum of their arcs with one label, and only arcs that reach ``least`` are followed. The
    n-grams are the paths of the sum, every prefix with the count of its own.
    """
    numbers: dict[bytes, int] = {}
    labels, offsets, arcs, base, roots, states = [], [], [], 0, [], 0
    for own, links, words in parts:
        label = np.array([0, ALONE, PHRASE, *(numbers.setdefault(w, len(numbers) + FIRST_WORD) for w in words)], np.int64)
        labels.append(label[links[:, 0]])
        offsets.append(own[:-1] + base)
        arcs.append(np.column_stack([links[:, 1], links[:, 2] + states]))
        roots.append(states + len(own) - 2)
        base, states = base + len(links), states + len(own) - 1
    label, first = np.concatenate(labels), np.concatenate([*offsets, [base]])
    weight, target = np.concatenate(arcs).T
    held, of = np.array(roots), np.zeros(len(roots), np.int64)  # states of the parts, and the state of the sum they are in
    paths = np.zeros((1, 0), np.int64)
    found, totals = [], []
    for _ in range(words_most + 1):
        sizes = first[held + 1] - first[held]
        which = np.repeat(of, sizes)
        arc = np.repeat(first[held] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        if not len(arc):
            break
        order = np.lexsort((label[arc], which))
        which, arc = which[order], arc[order]
        new = np.concatenate([[True], (which[1:] != which[:-1]) | (label[arc[1:]] != label[arc[:-1]])])
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(weight[arc], starts)
        good = sums >= least
        group = np.cumsum(new) - 1
        renumbered = np.cumsum(good) - 1
        follow = good[group]
        heads = arc[starts[good]]
        paths = np.column_stack([paths[which[starts[good]]], label[heads]])
        found.append(np.column_stack([paths, np.zeros((len(paths), words_most + 1 - paths.shape[1]), np.int64)]))
        totals.append(sums[good])
        of, held = renumbered[group[follow]], target[arc[follow]]
    if not found:
        return np.zeros((0, words_most + 1), np.int64), np.zeros(0, np.int64), []
    grams, totals = np.concatenate(found), np.concatenate(totals)
    order = np.lexsort(grams.T[::-1])
    return grams[order], totals[order], list(numbers)


def _range_of(words: list[bytes], seed: np.uint64, span: np.uint64) -> int:
    first = np.array([xxhash.xxh3_64_intdigest(w) for w in words[:2]], np.uint64) ^ seed
    own = first * _MIX[0] if len(words) == 1 else _pair(first[:1], first[1:])
    return int(own[0] // span)


def _united(shards: DataFrame, least: int, ranges: int, words_most: int) -> DataFrame:
    """Per range the sum of its transducers, and the candidates in it with their parts.

    Rows: (lang, place, data) of a transducer, or (lang, phrase, a, parts) of a candidate.
    """
    schema = pa.schema([
        ("lang", pa.string()), ("place", pa.int32()), ("data", pa.binary()), ("phrase", pa.binary()), ("a", pa.int64()),
        ("parts", pa.list_(pa.struct([("k", pa.int32()), ("first", pa.binary()), ("first_place", pa.int32()), ("rest", pa.binary()), ("rest_place", pa.int32())]))),
    ])

    def rows(lang, place, parts):
        grams, totals, words = unite(parts, least, words_most)
        if not len(grams):
            return
        # windows that end at a phrase are those that no longer one has
        depth = (grams > 0).sum(1)
        ends, totals_list = totals.copy(), totals.tolist()
        open_at = [0] * (words_most + 2)
        for i, d in enumerate(depth.tolist()):
            open_at[d] = i
            if d > 1:
                ends[open_at[d - 1]] -= totals_list[i]
        deep = depth > 1
        yield {"lang": lang, "place": place, "data": _packed(*build(grams[deep], ends[deep]), words)}
        seed, span = np.uint64(xxhash.xxh3_64_intdigest(lang.encode())), _span(ranges)
        for row, d, a in zip(grams.tolist(), depth.tolist(), totals_list):
            if row[0] == PHRASE and d > 2:
                own = [words[i - FIRST_WORD] for i in row[1:d]]
                cuts = []
                for k in range(1, len(own)):
                    x, y = own[:k], own[k:]
                    cuts.append({"k": k, "first": b" ".join(x), "first_place": _range_of(x, seed, span), "rest": b" ".join(y), "rest_place": _range_of(y, seed, span)})
                yield {"lang": lang, "phrase": b" ".join(own), "a": a, "parts": cuts}

    def run(batches):
        key, parts = None, []

        def done():
            held = []
            for row in rows(*key, parts):
                held.append(row)
                if len(held) >= 5000:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held = []
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=schema)

        for batch in batches:
            for lang, place, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (lang, place) != key:
                    if parts:
                        yield from done()
                    key, parts = (lang, place), []
                parts.append(_unpacked(data))
        if parts:
            yield from done()

    ddl = "lang string, place int, data binary, phrase binary, a bigint, parts array<struct<k:int,first:binary,first_place:int,rest:binary,rest_place:int>>"
    return shards.repartition(F.col("lang"), F.col("place")).sortWithinPartitions("lang", "place").mapInArrow(run, ddl)


def _composed(transducers: DataFrame, parts: DataFrame) -> DataFrame:
    """(lang, part, f): parts (lang, place, part) composed with the transducer of their range."""
    schema = pa.schema([("lang", pa.string()), ("part", pa.binary()), ("f", pa.int64())])

    def run(batches):
        key = offsets = arcs = None
        numbers: dict[bytes, int] = {}
        states: dict[int, dict[int, tuple[int, int]]] = {}

        def weight(part: bytes) -> int:
            words = part.split(b" ")
            labels = [PHRASE if len(words) > 1 else ALONE, *(numbers.get(w, 0) for w in words)]
            state, passed = len(offsets) - 2, 0
            for label in labels:
                if state not in states:
                    own = arcs[offsets[state] : offsets[state + 1]].tolist()
                    states[state] = {x: (w, t) for x, w, t in own}
                passed, state = states[state].get(label, (0, 0))
                if not passed:
                    return 0
            return passed

        for batch in batches:
            langs, found, weights = [], [], []
            for lang, place, data, part in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if data is not None:
                    key, states = (lang, place), {}
                    offsets, arcs, words = _unpacked(data)
                    numbers = {w: i for i, w in enumerate(words, FIRST_WORD)}
                elif (lang, place) == key:
                    langs.append(lang)
                    found.append(part)
                    weights.append(weight(part))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary()), pa.array(weights, pa.int64())], schema=schema)

    both = transducers.select("lang", "place", "data", F.lit(None).cast("binary").alias("part")).unionByName(parts.select("lang", "place", F.lit(None).cast("binary").alias("data"), "part"))
    met = both.repartition(F.col("lang"), F.col("place")).sortWithinPartitions("lang", "place", F.col("data").isNull())
    return met.mapInArrow(run, "lang string, part binary, f bigint")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, words_most: int = WORDS) -> DataFrame:
    """The ``top`` phrases of every language: (lang, rank, phrase, a, l, r, n, score).

    A phrase of 2 to ``words_most`` words counts if it stands ``least`` times or more within
    pieces of the texts; its score is that of its worst cut, and it goes if a longer phrase
    with the same count holds it. A phrase inside a longer one of the same count also lies
    inside one that is longer by one word and has that count, so phrases are only held
    against their own longest parts.

    Null and empty texts and texts without words add nothing, a null language is ``und``,
    an empty language stays its own; repeated rows count each time; an empty table, or one
    without frequent phrases, gives no rows; other columns are not read. Ties are ordered by
    count, then by the phrase's bytes.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), whole_text(f"`{text}`").cast("binary").alias("text"))
    sketched = cut_lineage(_sketched(texts))
    total = sketched.groupBy("lang").agg(F.sum("n").alias("n")).where("n IS NOT NULL")
    corpus = total.agg(F.sum("n")).first()[0] or 0
    ranges = int(max(1, -(-corpus // RANGE_WORDS)))
    bits = docs.sparkSession.sparkContext.broadcast(_passing(sketched, least))
    schema = pa.schema([("lang", pa.string()), ("place", pa.int32()), ("data", pa.binary())])

    def shard_rows(batches):
        for row in _in_shards(batches, lambda name, shard: _transducers(name, shard, bits.value, ranges, words_most)):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

    shards = cut_lineage(texts.mapInArrow(shard_rows, "lang string, place int, data binary"))
    united = cut_lineage(_united(shards, least, ranges, words_most))
    release(shards)
    cuts = united.where("phrase IS NOT NULL").select("lang", "phrase", "a", F.inline("parts"))
    both = F.explode(F.array(F.struct(F.col("first").alias("part"), F.col("first_place").alias("place")), F.struct(F.col("rest").alias("part"), F.col("rest_place").alias("place")))).alias("p")
    asked = cuts.select("lang", both).select("lang", "p.*").distinct()
    known = cut_lineage(_composed(united.where("data IS NOT NULL"), asked))
    scored = (
        cuts.join(known.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(known.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(total, "lang")
    )
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    scored = scored.withColumn("above", F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n")).withColumn("below", exact("l") * exact("r"))
    cut = F.struct(F.expr("above div below").alias("score"), "k", "l", "r")
    words = F.size(F.split(F.col("phrase").cast("string"), " ", -1))
    inside = F.when((F.col("k") == words - 1) & (F.col("l") == F.col("a")), F.col("first")), F.when((F.col("k") == 1) & (F.col("r") == F.col("a")), F.col("rest"))
    worst = cut_lineage(
        scored.groupBy("lang", "phrase").agg(F.min(cut).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n"), F.array_compact(F.array(*(F.max(c) for c in inside))).alias("inside"))
    )
    release(united, known)
    covered = worst.select("lang", F.explode("inside").alias("phrase")).distinct()
    left = worst.join(covered, ["lang", "phrase"], "left_anti")
    best = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALT)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
