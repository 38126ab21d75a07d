"""Byte-level network: gradients, held-out accuracy, cover of the whole document."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from mediamix.llm import bytenet

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    network = bytenet.train(docs, labels)
    scored = bytenet.classify(docs, network, keep=["doc_id"], name="found").join(labels, "doc_id").select("doc_id", "found.*", F.col("quality").alias("label"))
    rows = [r for r in scored.collect() if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    good, bad = ([r.score for r in rows if r.label == v] for v in (1, 0))
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.93, auc
    assert np.mean([r.predicted == r.label for r in rows]) > 0.88


def test_sample_leaves_the_fold_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    ids = [r.id for r in bytenet.sample(docs, labels, documents=30).collect()]
    assert len(ids) == len(set(ids)) == 60 and all(bytenet.fold_of(i) for i in ids)


def test_whole_texts_are_learned_from(spark, docs, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(k, rng.integers(97, 123, size, np.uint8).tobytes().decode()) for k, size in enumerate([300, 9_000, 60_000, 2_000] * 3)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k, _ in rows], "doc_id bigint, quality int, toxic int")
    seen, given = set(), []
    step, last = bytenet.Network.gradients, bytenet.Network.fit_combination
    monkeypatch.setattr(bytenet.Network, "gradients", lambda self, v, *more: (seen.update(x.tobytes() for x in v), step(self, v, *more))[1])
    monkeypatch.setattr(bytenet.Network, "fit_combination", lambda self, f, *more: (given.append(f), last(self, f, *more))[1])
    network = bytenet.train(docs(rows), labels)
    texts = [t.encode() for k, t in rows if bytenet.fold_of(k)]
    assert seen == {c.tobytes() for t in texts for c in bytenet.chunks_of(t)}
    assert np.allclose(given[0], [network.features(network.logits(t), len(t)) for t in texts], atol=1e-6)


def test_held_out_accuracy_of_long_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    scored = bytenet.classify(docs, bytenet.train(docs, labels), keep=["doc_id", "n_chars"], name="found").join(labels, "doc_id")
    rows = [r for r in scored.where(f"found.held_out AND n_chars > {7 * bytenet.SPAN}").select("found.score", "quality").collect()]
    good, bad = ([r.score for r in rows if r.quality == v] for v in (1, 0))
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.9


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    network = bytenet.Network()
    for name in ("embedding", "filters", "filter_bias", "inner", "inner_bias", "outer", "outer_bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    values = np.stack([bytenet.chunks_of(rng.integers(97, 105, 400, np.uint8).tobytes())[0] for _ in range(3)])
    target, weight = np.array([0.0, 1, 1]), np.array([1.0, 2, 0.5])

    def loss():
        x = np.stack([network.windows(v) for v in values])
        z = network.head(np.maximum((x @ network.filters).max(1) + network.filter_bias, 0))[0]
        return (weight * (np.log1p(np.exp(z)) - target * z)).mean()

    for w, g in zip(network.weights(), network.gradients(values, target, weight)):
        for at in np.argsort(-np.abs(g), axis=None)[:3]:
            flat, step = w.reshape(-1), 1e-6
            flat[at] += step
            up = loss()
            flat[at] -= 2 * step
            down = loss()
            flat[at] += step
            assert abs((up - down) / (2 * step) - g.reshape(-1)[at]) < 1e-5


def test_segments_and_places_do_not_matter(monkeypatch):
    network = bytenet.Network()
    data = bytes(np.random.default_rng(1).integers(32, 127, 40_000, np.uint8))
    whole = network.logits(data)
    assert len(whole) == -(-40_000 // bytenet.SPAN) - 1
    monkeypatch.setattr(bytenet, "SEGMENT_HALVES", 7)
    assert np.allclose(network.logits(data), whole, atol=1e-5)
    changed = bytearray(data)
    changed[39_990:] = b"#" * 10  # the last bytes count
    assert network.logits(bytes(changed))[-1] != whole[-1]


def test_nulls_empty_ties_columns(spark, docs):
    rows = [(1, None), (2, ""), (None, "some text"), (3, "same"), (3, "same"), (4, "é" * 300_000)]
    more = docs(rows).withColumn("quality", F.lit("x")).withColumn("score", F.lit(1))
    network = bytenet.train(docs(rows), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    out = bytenet.classify(more, network, keep=["doc_id", "quality"], name="found").select("doc_id", "quality", "found.*").collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.quality == "x" for r in out)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert len(by[3]) == 1 and by[1] == by[2]
    assert bytenet.classify(docs([]), network, name="q").count() == 0
