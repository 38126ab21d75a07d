"""Chat formatting: fold, reversible rendering, digests."""

import hashlib
import random

from pyspark.sql import functions as F

from mediamix.llm import chat, queries

DATA = "/root/testdata/sf0.001"


def test_fold_of_deltas_edits_regenerations():
    events = [
        ("message", 1, "user", "hi"),
        ("delta", 2, "assistant", "Hel"),
        ("delta", 2, "assistant", "lo"),
        ("edit", 1, None, "hi there"),
        ("regenerate", 2, None, None),
        ("delta", 2, "assistant", "Good "),
        ("delta", 2, "assistant", "day"),
        ("message", 3, None, None),
        ("message", 4, "user", "gone"),
        ("retract", 4, None, None),
        ("edit", 9, None, "unknown"),
        ("message", 1, "user", "again"),
        ("edit", 1, None, "again!"),
    ]
    assert chat.fold(events) == [["user", "hi there"], ["assistant", "Good day"], ["", ""], ["user", "again!"]]
    assert chat.fold([]) == []


def test_rendering_is_reversible():
    rng = random.Random(3)
    bits = ["<|im_end|>", "<|im_start|>", "\\", "<|", "|>", "<", "|", "\n", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "é", "x", "[", "/"]
    for _ in range(3000):
        turns = [["".join(rng.choice(bits) for _ in range(rng.randrange(4))), "".join(rng.choice(bits) for _ in range(rng.randrange(12)))] for _ in range(rng.randrange(4))]
        text, spans = chat.render(turns, frozenset({"", "x"}))
        assert [list(t) for t in chat.parse(text)] == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r in ("", "x")]
        for _, body in turns:
            assert not any(c in chat.escape(body) for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_query_digests(spark):
    rows = spark.read.parquet(f"{DATA}/conversations.parquet").collect()
    by = {-1: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in rows:
        by.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    got = {r.conv_id: r for r in queries.op6_chat(spark, DATA).collect()}
    assert set(got) == set(by)
    for key, turns in by.items():
        turns.sort()
        learned = "".join(t for _, r, t in turns if r == "assistant")
        assert got[key].n_turns == len(turns)
        assert got[key].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[key].loss_chars, got[key].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def log(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, seq bigint, kind string, message bigint, role string, text string")


def test_log_is_sorted_and_split_by_conversation(spark):
    rows = [(c, s, "message" if s % 3 == 0 else "delta", s // 3, "assistant" if s % 2 else "user", f"{c}.{s} ") for c in range(20) for s in range(30)]
    random.Random(1).shuffle(rows)
    out = {r.conv_id: chat.parse(r.formatted) for r in chat.format_log(log(spark, rows)).collect()}
    assert out == {c: [("assistant" if m % 2 else "user", "".join(f"{c}.{3 * m + i} " for i in range(3))) for m in range(10)] for c in range(20)}


def test_nulls_ties_long_and_columns(spark, monkeypatch):
    rows = [(None, None, "message", None, None, None), (None, 1, "message", None, "user", "x"), (1, 5, "message", 1, "user", "same"), (1, 5, "message", 1, "user", "same"), (2, 1, "message", 1, "assistant", "y" * 2_000_000)]
    more = log(spark, rows).withColumn("conv", F.lit("z")).withColumn("__seq", F.lit(1))
    out = {r.conv_id: (r.n_turns, [len(t) for _, t in chat.parse(r.formatted)]) for r in chat.format_log(more).collect()}
    assert out == {None: (2, [0, 1]), 1: (2, [4, 4]), 2: (1, [2_000_000])}
    assert chat.format_log(log(spark, [])).count() == 0


def test_history_has_every_kind_and_ends_in_the_rows(spark):
    rows = [(c, t, "assistant" if t % 2 else "user", f"text {c} {t} é") for c in range(30) for t in range(4)]
    rows += [(None, 0, None, None), (40, None, "user", "no turn"), (41, 1, "user", "same"), (41, 1, "user", "same"), (41, 1, "assistant", "a"), (42, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("whole", F.lit("x")).withColumn("row", F.lit(0))
    history = chat.history_of_rows(df).repartition(7)
    assert {r.kind for r in history.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate", "retract"}
    out = {r.conv_id: chat.parse(r.formatted) for r in chat.format_log(history, order=chat.HISTORY_ORDER).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert out == {c: [(r, x) for _, r, x in sorted(turns)] for c, turns in by.items()}
