"""Conversation repair against brute force over all edit sequences."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from mediamix.llm import repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {c: sorted(m, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, m in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        content = text.rstrip(SPACE)
        out.append("b" if not content else "d" if (role, text) in seen else "t" if content[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired) by trying every edit of every row, and up to two insertions at every place."""
    best = None
    choices = [["D"] if f in ("b", "d") else ["K", "Ru", "Ra", "D"] for f in found]
    for edits in itertools.product(*choices):
        kept, base = [], 0
        for (_, role, text), f, edit in zip(rows, found, edits):
            base += {"K": 0, "D": 4}.get(edit, 3) + (3 if f == "t" and edit != "D" else 0)
            kept.append((edit, None if edit == "D" else role if edit == "K" else {"u": "user", "a": "assistant"}[edit[1]], text))
        for gaps in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            cost = base + 3 * sum(map(len, gaps))
            if best is not None and cost > best[0]:
                continue
            out, audit = [], ""
            for i, gap in enumerate(gaps):
                out += [("user" if g == "u" else "assistant", "") for g in gap]
                audit += "I" * len(gap)
                if i < len(kept):
                    audit += kept[i][0][0]
                    out += [kept[i][1:]] if kept[i][1] is not None else []
            if GRAMMAR.fullmatch("".join(r[:1] if r[:1] else "-" for r, _ in out)):
                best = min(best or (cost, audit, out), (cost, audit, out), key=lambda b: b[:2])
    return best


def brute(rows):
    result = {}
    for conv, own in damaged(rows).items():
        found = faults(own)
        turns = {t for t, _, _ in own if t is not None}
        cost, audit, out = cheapest(own, found)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        text = "\n".join(f"{r}:{t}" for r, t in out)
        result[conv] = (gaps, *(found.count(f) for f in "bdt"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return result


def ours(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[c] for c in columns) for r in repair.damage_and_repair(df, **options).collect()}


def test_random_conversations(spark):
    rng = random.Random(4)
    texts = ["Yes.", "no", "What?", "", " \n", None, "Yes. "]
    roles = ["system", "user", "assistant", "tool", "", None]
    rows = [(c, t, rng.choice(roles[: rng.choice([3, 6])]), rng.choice(texts)) for c in range(150) for t in range(rng.randint(1, 4))]
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hi."), (900, None, "user", "Hi."), (900, None, "assistant", "Hi."), (900, 3, "user", "Hi.")]
    rows += [(901, 2, "user", "Same.")] * 3 + [(901, 3, "assistant", "One."), (901, 3, "assistant", "Two.")]
    assert ours(spark, rows) == brute(rows)


def test_all_dropped_and_empty(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert ours(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    assert repair.damage_and_repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nodes_are_shared():
    automaton = repair.Suffixes()
    made = []
    keep = automaton._node
    automaton._node = lambda costs, edits: (made.append(1), keep(costs, edits))
    signatures = sorted(s[::-1] for s in ["ua", "sua", "uua", "suaua", "xua"])
    for backwards in signatures:
        automaton.read(backwards)
    assert len(made) == len({s[:n] for s in signatures for n in range(1, len(s) + 1)})


def test_one_very_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(60_000)]
    ((gaps, blank, duplicate, truncated, illegal, cost, audit, _),) = ours(spark, rows).values()
    kept = damaged(rows)[1]
    assert len(audit.replace("I", "")) == len(kept) and duplicate == sum(a == b for a, b in zip(kept, kept[1:])) and blank and truncated and illegal and cost
    assert gaps == kept[-1][0] - kept[0][0] + 1 - len({t for t, _, _ in kept})


def test_repaired_turns_and_other_columns(spark):
    rows = [(1, 0, "user", "Hi.", "x"), (1, 1, "assistant", "Hello.", "y"), (2, 5, "assistant", "Ok.", "z")]
    df = spark.createDataFrame(rows, SCHEMA + ", audit string").withColumnRenamed("audit", "cost")
    out = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in repair.damage_and_repair(df, with_text=True).collect()}
    for turns in out.values():
        assert GRAMMAR.fullmatch("".join(r[0] for r, _ in turns))


@pytest.mark.parametrize("signature, want", [("sua", (0, "KKK")), ("u", (3, "KI")), ("a", (3, "IK")), ("ss", (6, "KIR")), ("", (0, ""))])
def test_small_signatures(signature, want):
    assert repair.Suffixes().read(signature[::-1]) == want
