"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mediamix.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def packed(text):
    return np.array(LIBRARY.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def decoded(text):
    return LIBRARY.decode(LIBRARY.encode(text, add_special_tokens=False).ids, skip_special_tokens=False)


def odd_texts():
    rng = random.Random(1)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["", " ", "a  b", " \n b", "a   b", "a \n\n  c", "<|endoftext|>x<|endoftext|>", "ab" * 3000 + " é́", "\x1c \x85x\xa0y", "don't I'LL 12³½ ㊿", "͸ x࢏౜y", "x" * 63 + "y" * 3, "the" * 67]
    texts += ["".join(chr(c) for c in range(0x250))]
    return texts + ["".join(rng.choice([chr(rng.choice(points)), chr(rng.randrange(0x3000)), rng.choice(" \n\t'sltaé1.")]) for _ in range(rng.randrange(40))) for _ in range(2000)]


def test_encodes_and_decodes_as_the_library():
    texts = odd_texts()
    model = bpe.ByteBpe(PATH)
    for text, ids in zip(texts, model.encode(texts)):
        assert ids == packed(text), repr(text)
        assert model.decode(ids) == decoded(text)
    assert model.decode(np.array([5000, 200, 162], "<u4").tobytes()) == LIBRARY.decode([5000, 200, 162], skip_special_tokens=False)


def test_small_memory_and_matrices_change_nothing(monkeypatch):
    texts = odd_texts()[:400]
    expected = bpe.ByteBpe(PATH).encode(texts)
    for name, value in (("REMEMBERED", 20), ("ROWS", 3), ("CHARACTERS", 50), ("LONG_WORD", 4)):
        monkeypatch.setattr(bpe, name, value)
    assert bpe.ByteBpe(PATH).encode(texts) == expected


def test_small_table(spark, docs, texts):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.round_trip) for r in bpe.encode_decode(docs(texts), PATH).collect()}
    assert got == {k: (len(packed(t)) // 4, hashlib.sha256(packed(t)).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), True) for k, t in texts}


def test_nulls_repeated_rows_and_columns(spark, docs):
    rows = [(1, None), (1, None), (None, "null id"), (2, ""), (3, "word " * 100_000)]
    more = docs(rows).withColumn("key", F.lit("x")).withColumn("n_tokens", F.lit(1))
    got = bpe.encode_decode(more, PATH, with_ids=True).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in got)[:4] == [(0, 2, "null id"), (1, 0, ""), (1, 0, ""), (2, 0, "")] and all(r.round_trip for r in got)
    assert bpe.encode_decode(docs([]), PATH).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.ByteBpe(public_tokenizers.path("word_bpe_49k.json"))
