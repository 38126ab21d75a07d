"""Packing: the library's ids, whole coverage, few sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mediamix.llm import common, packing

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, packed, capacity=4096):
    """Every piece as it must be; sequences without gap or overflow."""
    expected = {}
    for key, text in rows:
        whole = ids(text)
        for n, a in enumerate(range(0, len(whole), capacity)):
            part = whole[a : a + capacity]
            expected.setdefault((key, n, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())), []).append(1)
    found = {}
    places = {}
    for r in packed:
        found.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert found == expected
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(k[3] * len(v) for k, v in expected.items())


def test_small_table_is_packed_tightly(spark, docs, texts):
    sequences, tokens = check(texts, packing.pack_documents(docs(texts), PATH).collect())
    assert sequences <= -(-tokens // 4096) + 1


def test_encoder_equals_the_library():
    rng = random.Random(1)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["", " ", "\n \n", "á b", "́ ̸x ≠", "ΑΣ ΟΔΟΣ\nΣ", "İ İ", "<|endoftext|> a<|startoftext|>b", "don't  we'LL\t\x1c\x85 x", "x" * 3000]
    texts += ["".join(rng.choice([chr(rng.choice(points)), chr(rng.randrange(0x3000)), rng.choice(" \n\t'slté1.")]) for _ in range(rng.randrange(40))) for _ in range(2000)]
    model = packing.Encoder(PATH)
    assert model.apart
    texts += ["<|ENDOFTEXT|> A", "a<|endoftext|><|endoftext|>", "I\u0307 K\u030a A\u030a \u212a", "<|"]
    for text, got in zip(texts, model.encode(texts)):
        assert got == np.array(ids(text)[:-1], "<u4").tobytes(), repr(text)


def test_nulls_long_texts_repeated_rows_and_columns(spark, docs):
    long = " ".join(f"word{i}" for i in range(20_000))
    rows = [(1, None), (1, None), (2, ""), (None, "null id"), (3, long), (4, "short text"), (4, "short text")]
    more = docs(rows).withColumn("piece", F.lit("x")).withColumn("key", F.lit(1)).withColumn("members", F.lit(2))
    check(rows, packing.pack_documents(more, PATH).collect())
    assert packing.pack_documents(docs([]), PATH).count() == 0


def test_rounds_over_many_tasks(spark, monkeypatch):
    rng = random.Random(4)
    lengths = [rng.choice([rng.randrange(1, 40), rng.randrange(300, 900), rng.randrange(2100, 4096), 4096]) for _ in range(6000)]
    cut = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)], "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    monkeypatch.setattr(packing, "BLOCK", 500)
    packed = packing.pack(cut.repartitionByRange(40, "length")).collect()
    assert sorted(r.doc_id for r in packed) == list(range(6000))
    fill = {}
    for r in packed:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096
    assert len(fill) <= max(-(-sum(lengths) // 4096), sum(n > 2048 for n in lengths)) * 1.01 + 1


def test_sequences_hold_their_pieces_ids(spark, docs):
    rows = [(i, f"text number {i} " * (i + 1)) for i in range(30)]
    cut = packing.pieces(docs(rows), PATH, capacity=64, with_ids=True)
    packed = packing.pack(cut, capacity=64)
    got = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(cut, packed).collect()}
    by_doc = {k: ids(t) for k, t in rows}
    for r in packed.collect():
        assert got[r.sequence_id][r.offset : r.offset + r.length] == by_doc[r.doc_id][r.start : r.start + r.length]


def test_later_rounds_know_numbers_and_totals_only(spark, monkeypatch):
    cut = spark.createDataFrame([(i, 0, 0, i % 50 + 1, 0) for i in range(40_000)], "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    monkeypatch.setattr(packing, "BLOCK", 300)
    rounds, made = [], packing._round
    monkeypatch.setattr(packing, "_round", lambda *a: rounds.append(a[-1]) or made(*a))
    packed = packing.pack(cut).collect()
    assert len(packed) == 40_000 and len({(r.sequence_id, r.offset) for r in packed}) == 40_000
    assert len({r.sequence_id for r in packed}) <= 1.1 * 25.5 * 40_000 / 4096 + 1
    assert len(rounds) > 1 and all(names == ["item", "size"] for names in rounds[1:])


def test_memory_of_a_worker_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 100_000)
    model = packing.Encoder(PATH)
    for i in range(20):
        model.encode([" ".join(f"w{i}x{j}" for j in range(500))])
        assert len(model.new) + len(model.old) <= 2 * (100_000 // packing.ENTRY + 500)
    common.remember("packing", model.forget)
    common.turn_to("packing")
    assert model.new
    common.turn_to("quality")
    assert not model.new and not model.old


def test_batches_are_cut_by_bytes():
    texts = ["x" * n for n in (10, 5000, 10, 10, 3000, 3000, 0)] + [None] * 3
    batch = pa.RecordBatch.from_pydict({"id": list(range(10)), "text": texts})
    parts = list(common.by_bytes([batch, batch.slice(0, 0)], 4000))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 4000 for p in parts)
