"""Quality rules against plain counting."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mediamix.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n, repeat = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), repeat, n < 50 or 100 * repeat > 50 * n)


def base(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_base_counts_of_the_small_table(spark, docs, texts):
    rows = [*texts, (10**6, "a b c a b c a\n\n a\n a\x0bb\x1cc\xa0d é"), (10**6 + 1, "x\r\nx\r\n \nx\n")]
    got = {r.doc_id: r for r in quality.judge(docs(rows), keep=["doc_id"]).select("doc_id", "quality.*").collect()}
    for key, text in rows:
        assert base(got[key]) == brute(text), key
        assert not (got[key].kept and got[key].base_failed)


def plain_distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    return math.sqrt(sum(x * math.log2(x / z) / 2 for v in (p, q) for x, z in zip(v, m) if x))


def test_distances_are_jensen_shannon(spark, docs, texts):
    rows = [(k, t, "en" if k % 3 else None) for k, t in texts if len(WORD.findall(t or "")) >= 50]
    means = {}
    shares = {}
    for key, text, lang in rows:
        m = quality.Measured(text)
        shares[key] = [*(m.chars / m.chars.sum()), *(m.common() / len(m.words))]
        for of in {lang, None}:
            means.setdefault(of, []).append(shares[key])
    means = {k: [sum(c) / len(v) for c in zip(*v)] for k, v in means.items()}
    n = quality.N_CLASSES
    for r in quality.judge(docs(rows), keep=["doc_id", "lang"]).select("doc_id", "lang", "quality.*").collect():
        own, every = means[r.lang], means[None]
        blend = [(a + b) / 2 for a, b in zip(own, every)]
        for got, part in ((r.char_distance, slice(0, n)), (r.word_distance, slice(n, None))):
            assert got == pytest.approx(min(plain_distance(shares[r.doc_id][part], x[part]) for x in (own, blend)), abs=1e-6)


def test_junk_goes_and_clean_stays(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    judged = quality.judge(docs, keep=["doc_id"], name="found").join(labels, "doc_id").where("found.n_words >= 50")
    shares = {r.quality: r.share for r in judged.groupBy("quality").agg(F.avg(F.col("found.kept").cast("int")).alias("share")).collect()}
    assert shares[1] > 0.995 and shares[0] < 0.04


def test_clean_documents_without_a_reference_stay(spark):
    """Languages that are null or rare; the mean over all would reject nearly all of their clean documents."""

    def shares(sf, lang, where):
        docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{n}.parquet") for n in ("documents", "labels"))
        judged = quality.judge(docs.withColumn("lang", lang), name="found").join(labels, "doc_id").where(f"found.n_words >= 50 AND {where}")
        return {r.quality: r.share for r in judged.groupBy("quality").agg(F.avg(F.col("found.kept").cast("int")).alias("share")).collect()}

    null = shares("sf0.1", F.when(F.col("doc_id") % 5 > 0, F.col("lang")), "lang IS NULL")
    assert null[1] > 0.995 and null[0] < 0.06
    assert shares("sf0.001", F.col("lang"), "lang = 'es'")[1] == 1  # 16 long documents
    rare = shares("sf0.1", F.when(F.col("doc_id") % 7 > 0, F.col("lang")).otherwise(F.concat("lang", (F.col("doc_id") % 200).cast("string"))), "length(lang) > 2")
    assert rare[1] > 0.99 and rare[0] < 0.6  # languages of a few documents: little is certain


def test_null_language_is_open_without_references(spark, docs, texts):
    found = quality.judge(docs([(k, t, None) for k, t in texts])).select("quality.*").collect()
    assert all(r.kept != r.base_failed for r in found)


def test_edges(spark, docs):
    rows = [(1, None, "en"), (2, "", None), (None, "word " * 60, "en"), (3, "a b " * 400_000, "xx"), (3, "a b " * 400_000, "xx")]
    more = docs(rows).withColumn("quality", F.lit("mine")).withColumn("shares", F.lit(1)).withColumn("__lang", F.lit(2))
    out = quality.judge(more, name="found")
    assert out.columns == [*more.columns, "found"] and out.count() == 5
    assert quality.accepted(more).columns == more.columns and quality.accepted(more).count() == 0
    assert quality.judge(docs([])).count() == 0
    assert quality.judge(docs([(1, None), (2, "short")])).where("quality.kept").count() == 0
