"""Line dedup against brute force over all runs."""

import random

from pyspark.sql import functions as F

from mediamix.llm import linededup


def brute(rows, least):
    """{(doc_id, kept lines)}: a line goes if it is in a run of enough words seen earlier."""
    places = []
    for key, text in sorted(rows):
        lines = [x.strip() for x in (text or "").split("\n") if x.strip()]
        places.append((key, lines))
    seen, out = set(), {}
    for key, lines in places:
        gone = set()
        for a in range(len(lines)):
            total = 0
            for b in range(a, len(lines)):
                total += len(lines[b].split())
                run = tuple(lines[a : b + 1])
                if total >= least:
                    if run in seen:
                        gone.update(range(a, b + 1))
        # runs of this document that start earlier count as seen, too
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(lines[a : b + 1])
                if sum(len(x.split()) for x in run) >= least:
                    if any(tuple(lines[c : c + len(run)]) == run for c in range(a)):
                        gone.update(range(a, b + 1))
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                seen.add(tuple(lines[a : b + 1]))
        out[key] = [x for n, x in enumerate(lines) if n not in gone]
    return out


def ours(docs, least):
    found = linededup.dedup_lines(docs, least_words=least).select("doc_id", "dedup.text").collect()
    return {r.doc_id: [x.strip() for x in r.text.split("\n") if x.strip()] for r in found}


def test_random_runs_equal_brute_force(spark, docs):
    rng = random.Random(3)
    pool = [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([1, 2, 3, 8, 12]))) for _ in range(25)]
    rows = []
    for key in range(40):
        lines = [rng.choice(pool) if rng.random() < 0.8 else f"own {key} {n}" for n in range(rng.randrange(14))]
        for _ in range(2):
            if rows and rng.random() < 0.7:  # a passage of an earlier document
                other = rng.choice(rows)[1].split("\n")
                a = rng.randrange(len(other))
                lines[rng.randrange(len(lines) + 1) : 0] = other[a : a + 5]
        rows.append((key, "\n".join(lines)))
    assert ours(docs(rows), 10) == brute(rows, 10)


def test_small_table(spark, docs, texts):
    short = [(k, t) for k, t in texts if t.count("\n") < 40]
    assert ours(docs(short), 50) == brute(short, 50)


def test_nulls_blank_lines_ties_and_long(spark, docs):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    long = "\n".join(f"line {i} of a long text" for i in range(50_000))
    rows = [(1, f"{a}\n\nshort\n{b}\r\n"), (2, f"first\n{a}\n\nnext"), (3, None), (3, None), (4, ""), (None, f"{b}\nlast"), (7, f"{a}\n{a}"), (5, long), (6, long + "\nmore")]
    found = {(r.doc_id, r.text) for r in linededup.dedup_lines(docs(rows), keep=["doc_id"]).select("doc_id", "dedup.text").collect()}
    assert found == {(1, f"{a}\n\nshort\n{b}\r\n"), (2, "first\nnext"), (3, ""), (4, ""), (None, "last"), (7, ""), (5, long), (6, "more")}


def test_same_row_twice_stays_and_columns_pass(spark, docs):
    a = " ".join(f"a{i}" for i in range(60))
    more = docs([(1, a), (1, a), (2, a + "\nrest"), (3, a)]).withColumn("dedup", F.lit("x")).withColumn("__id", F.lit(5)).withColumn("content", F.lit(1))
    out = linededup.deduped(more)
    assert out.columns == more.columns
    assert sorted((r.doc_id, r.text, r.n_chars, r.dedup) for r in out.collect()) == [(1, a, len(a), "x"), (1, a, len(a), "x"), (2, "rest", 4, "x")]
    assert linededup.dedup_lines(docs([])).count() == 0
