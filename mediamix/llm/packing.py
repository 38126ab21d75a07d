"""Best-fit packing of token pieces into sequences by hierarchical residual packing.

Items are dealt to tasks by hash. Every task packs its own best-fit, longest first. Sequences that are nearly full are
done; the underfull ones become items of the next round, where fewer tasks meet more of
them, until one task can hold what is left or a round no longer helps. Tasks work on
blocks of a bounded number of items, and an item is a number and a length, whatever it holds.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mediamix.llm.common import map_batches, remember, turn_to, type_of, whole_text
from mediamix.session import cut_lineage, release

CAPACITY, END_ID = 4096, 1
#: Items that a task packs at a time.
BLOCK = 1 << 16
#: A sequence with so few tokens free is done before the last round.
NEARLY = 8
#: A round that leaves more than this share of its items is the last.
NO_HELP = 0.95
#: Bytes of stretches and ids that a worker remembers in each of two generations, and about
#: what an entry takes besides its own.
REMEMBERED, ENTRY = 120 << 20, 200
#: Characters that are split at a time, and new stretches that are encoded at a time.
CHARACTERS, TOGETHER = 1 << 20, 128


class Encoder:
    """Ids by the tokenizers library, with remembered stretches between spaces and line feeds.

    For vocabularies that drop white space, lower-case, and whose words and normalization
    never look across a space or line feed; checked on loading, else texts go whole. New
    stretches are encoded together, parted by a special token, whose id parts their ids.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        special = [(t.content, i) for i, t in self.library.get_added_tokens_decoder().items() if t.special and not (t.single_word or t.lstrip or t.rstrip or t.normalized)]
        self.mark, self.mark_id = special[-1] if special else ("", -1)
        split = self._whole("ab") + self._whole("cd") + self._whole("!")
        self.apart = bool(special) and self._whole("AB \n cd !") == split and not self._whole(" \n") and all(c.startswith("<|") for c, _ in special)
        self.forget()

    def forget(self) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _remember(self, parts: set[str]) -> None:
        if self.held > REMEMBERED:
            self.old, self.new, self.held = self.new, {}, 0
        missing = parts.difference(self.new)
        self.held += sum(ENTRY + 5 * len(part) for part in missing)
        for part in missing.intersection(self.old):
            self.new[part] = self.old[part]
        missing = missing.difference(self.old)
        odd = [m for m in missing if "<|" in m]
        self.new.update((m, self._whole(m)) for m in odd)
        plain = list(missing.difference(odd))
        for start in range(0, len(plain), TOGETHER):
            some = plain[start : start + TOGETHER]
            ids = np.array(self.library.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)[0].ids, "<u4")  # no offsets
            ends = np.flatnonzero(ids == self.mark_id)
            data = ids.tobytes()
            for part, a, b in zip(some, [0, *(4 * (ends + 1)).tolist()], [*(4 * ends).tolist(), len(data)]):
                self.new[part] = data[a:b]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        if not self.apart:
            return [self._whole(t) for t in texts]
        out, start = [], 0
        while start < len(texts):
            end, size, split = start, 0, []
            while end < len(texts) and (end == start or size < CHARACTERS):
                text = texts[end]
                if "<|" not in text:  # those may hold special tokens, which are found before lower-casing
                    text = text.encode().lower().decode()  # ASCII letters only
                split.append(text.replace("\n", " ").split(" "))
                size += len(text)
                end += 1
            self._remember(set().union(*split))
            ids = self.new.__getitem__
            out += [b"".join(map(ids, parts)) for parts in split]
            start = end
        return out


@functools.lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Token pieces of every document: its ids and ``end_id``, cut only where longer than ``capacity``.

    Returns ``key``, ``piece`` (from 0), ``start`` (ids of the document before it),
    ``length``, ``ids_crc32`` and, with ``with_ids``, ``ids`` (binary). A null text is an
    empty one: a piece of ``end_id`` alone.
    """

    def make():
        model, end = load(vocabulary), np.uint32(end_id).tobytes()
        remember("packing", model.forget)

        def run(columns: dict) -> dict:
            rows = []
            for number, ids in zip(columns["key"], model.encode(columns["text"])):
                ids += end
                for n, a in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[a : a + 4 * capacity]
                    rows.append((number, n, a // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
            return dict(zip(names, map(list, zip(*rows))))

        return run

    ddl = f"key {type_of(docs, key)}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    names = StructType.fromDDL(ddl).names
    return map_batches(docs.select(F.col(key).alias("key"), whole_text(text).alias("text")), make, ddl, "packing").withColumnRenamed("key", key)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit r: there is a bin with r free
    for item in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        size = lengths[item]
        fitting = some >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_ = room[free].pop()
            if not room[free]:
                some ^= 1 << free
        else:
            free, bin_ = capacity, len(bins)
            bins.append([])
        bins[bin_].append(item)
        free -= size
        room[free].append(bin_)
        some |= 1 << free
    return bins


def _round(items: DataFrame, number: int, capacity: int, nearly: int, names: list[str]) -> DataFrame:
    """Pack items within each task: the columns ``names`` of each (the last is its size), and its place.

    Adds ``bin``, ``at`` (its offset there), ``total`` (of the bin) and ``done``.
    """
    schema = StructType([*(items.schema[c] for c in names), *StructType.fromDDL("bin bigint, at bigint, total bigint, done boolean").fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to("packing")
        task, made, held, n = TaskContext.get().partitionId(), 0, [], 0

        def packed() -> pa.RecordBatch:
            nonlocal made, held, n
            block = pa.Table.from_batches(held)
            sizes = block.column(len(names) - 1).to_pylist()
            order, bins, places, totals = [], [], [], []
            for bin_ in best_fit(sizes, capacity):
                at = 0
                for item in bin_:
                    places.append(at)
                    at += sizes[item]
                order += bin_
                bins += [(number << 56) + (task << 32) + made] * len(bin_)
                totals += [at] * len(bin_)
                made += 1
            held, n = [], 0
            moved = block.take(pa.array(order, pa.int64())).combine_chunks().to_batches()[0]
            done = [t >= capacity - nearly for t in totals]
            return pa.RecordBatch.from_arrays([*moved.columns, pa.array(bins, pa.int64()), pa.array(places, pa.int64()), pa.array(totals, pa.int64()), pa.array(done, pa.bool_())], schema=arrow)

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == BLOCK:
                    yield packed()
        if n:
            yield packed()

    return items.select(*names).mapInArrow(run, schema)


def pack(cut: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Place pieces (``key``, piece, start, length, ids_crc32) into as few sequences as it can.

    Returns the pieces with ``sequence_id`` and ``offset``; offsets of a sequence have no
    gap. Pieces of null or repeated keys are items like any other; none is dropped or cut.
    Lengths are 1 to ``capacity``. Which of equally long pieces go together is not defined,
    nor are the numbers of sequences.

    Later rounds know a bin by its number and total only; its members follow in the end, by
    joining each round's bins with those that they went into, from the last round back.
    """
    names = ["key", "piece", "start", "ids_crc32", "length"]
    items = cut.select(F.col(f"`{key}`").alias("key"), *names[1:])
    held = items.count()
    number, tasks, rounds = 0, max(1, -(-held // BLOCK)), []
    while True:
        # dealt anew by hash, so that every task meets long and short items, whatever the order of the input
        dealt = items.repartition(tasks, F.xxhash64(*names[:2], F.lit(number)))
        packed = cut_lineage(_round(dealt, number, capacity, NEARLY, names))
        rounds.append(packed)
        left = packed.where("NOT done AND at = 0").count()
        if left <= 1 or tasks == 1 or number and left > NO_HELP * held:
            break
        names = ["item", "size"]
        items = packed.where("NOT done AND at = 0").select(F.col("bin").alias("item"), F.col("total").alias("size"))
        number, held, tasks = number + 1, left, -(-left // BLOCK)
    final = rounds[-1].withColumns({"sequence_id": F.col("bin"), "offset": F.col("at")})
    for earlier in reversed(rounds[:-1]):
        places = final.select(F.col("item").alias("bin"), "sequence_id", F.col("offset").alias("shift"))
        moved = earlier.where("NOT done").join(places, "bin").withColumn("offset", F.col("at") + F.col("shift")).select(*earlier.columns, "sequence_id", "offset")
        final = moved.union(earlier.where("done").select("*", F.col("bin").alias("sequence_id"), F.col("at").alias("offset")))
    return final.select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(cut: DataFrame, packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Token ids of each sequence: (sequence_id, length, ids), from pieces with ids.

    For keys that are unique and not null. A sequence has at most its capacity of members.
    """
    named = packed.select(key, "piece", "sequence_id", "offset").join(cut.select(key, "piece", "length", "ids"), [key, "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return named.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``pieces`` of the documents, placed by ``pack``; an empty table gives no rows."""
    cut = cut_lineage(pieces(docs, vocabulary, key, text, capacity, end_id))
    packed = pack(cut, key, capacity)
    release(cut)
    return packed
