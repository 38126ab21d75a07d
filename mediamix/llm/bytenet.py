"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over the whole document, and the filters'
responses are max-pooled over overlapping chunks that together cover it. A small layer
turns the pooled responses of a chunk into its logit; the mean and the least logit of the
chunks and the length are combined into one probability.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.llm.common import append, map_batches, whole_text
from mediamix.session import cut_lineage, release

EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 8, 8, 2, 32, 16
#: Places of the filters in half a chunk; a chunk is two halves and shares one with each neighbour.
HALF = 128
SPAN = HALF * STRIDE
#: Documents per label the network is fitted on, and chunks of one that an epoch takes at
#: least; it takes as many as all epochs need to go through the whole document.
DOCUMENTS, CHUNKS = 1500, 6
FOLDS = 5
EPOCHS, BATCH, RATE = 12, 64, 3e-3
THRESHOLD = 0.3
#: Bytes of a document that are embedded at a time.
SEGMENT_HALVES = 64
PAD = 256


def fold_of(key: int | None) -> int:
    """Remainder of the CRC-32 of the id as text; of the empty text for a null id."""
    return zlib.crc32(b"" if key is None else str(key).encode()) % FOLDS


def padded(data: bytes) -> np.ndarray:
    """Byte values, padded to whole halves (two at least) and the reach of the last filter."""
    halves = max(2, -(-len(data) // SPAN))
    out = np.full(halves * SPAN + WIDTH - STRIDE, PAD, np.int16)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out


def chunks_of(data: bytes) -> np.ndarray:
    """Overlapping chunks that cover the document, each with the reach of its last filter."""
    values = padded(data)
    n = (len(values) - (WIDTH - STRIDE)) // SPAN - 1
    return np.stack([values[i * SPAN : (i + 2) * SPAN + WIDTH - STRIDE] for i in range(n)])


class Network:
    """Weights, chunk logits, and one step of learning."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.5, (257, EMBED)).astype(np.float32)
        self.embedding[PAD] = 0
        self.filters = rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32)
        self.filter_bias = np.zeros(FILTERS, np.float32)
        self.inner = rng.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32)
        self.inner_bias = np.zeros(HIDDEN, np.float32)
        self.outer = rng.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32)
        self.outer_bias = np.zeros(1, np.float32)
        #: bias, mean logit, least logit, log of the length
        self.combine = np.array([0, 0.5, 0.5, 0], np.float64)

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.filter_bias, self.inner, self.inner_bias, self.outer, self.outer_bias]

    def windows(self, values: np.ndarray) -> np.ndarray:
        """Embedded bytes under each place of the filters: (places, WIDTH * EMBED)."""
        embedded = self.embedding[values].reshape(-1)
        places = (len(values) - WIDTH) // STRIDE + 1
        step = embedded.strides[0]
        return np.ascontiguousarray(np.lib.stride_tricks.as_strided(embedded, (places, WIDTH * EMBED), (STRIDE * EMBED * step, step), writeable=False))

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(pooled @ self.inner + self.inner_bias, 0)
        return hidden @ self.outer + self.outer_bias[0], hidden

    def logits(self, data: bytes) -> np.ndarray:
        """One logit for each chunk of a whole document."""
        values = padded(data)
        halves = (len(values) - (WIDTH - STRIDE)) // SPAN
        most = []
        for first in range(0, halves, SEGMENT_HALVES):
            last = min(first + SEGMENT_HALVES, halves)
            part = values[first * SPAN : last * SPAN + WIDTH - STRIDE]
            most.append((self.windows(part) @ self.filters).reshape(last - first, HALF, FILTERS).max(1))
        most = np.concatenate(most)
        return self.head(np.maximum(np.maximum(most[:-1], most[1:]) + self.filter_bias, 0))[0]

    def features(self, logits: np.ndarray, size: int) -> np.ndarray:
        return np.array([1, logits.mean(), logits.min(), np.log1p(size) - 7])

    def score(self, data: bytes) -> float:
        z = self.features(self.logits(data), len(data)) @ self.combine
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))

    def gradients(self, values: np.ndarray, target: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the logistic loss over chunks (n, bytes), for ``weights``."""
        n = len(values)
        x = np.stack([self.windows(v) for v in values])
        response = x @ self.filters
        place = response.argmax(1)
        top = np.take_along_axis(response, place[:, None], 1)[:, 0] + self.filter_bias
        pooled = np.maximum(top, 0)
        z, hidden = self.head(pooled)
        dz = (1 / (1 + np.exp(-z)) - target) * weight / n
        dhidden = np.outer(dz, self.outer) * (hidden > 0)
        dtop = (dhidden @ self.inner.T) * (top > 0)
        reached = np.take_along_axis(x, place[:, :, None].repeat(WIDTH * EMBED, 2), 1)  # (n, FILTERS, WIDTH * EMBED)
        dfilters = np.einsum("nf,nfk->kf", dtop, reached)
        dembedding = np.zeros_like(self.embedding)
        under = (place * STRIDE)[:, :, None] + np.arange(WIDTH)
        bytes_under = np.take_along_axis(values[:, None, :].repeat(FILTERS, 1), under, 2)
        back = dtop[:, :, None, None] * self.filters.T.reshape(FILTERS, WIDTH, EMBED)[None]
        np.add.at(dembedding, bytes_under.reshape(-1), back.reshape(-1, EMBED))
        dembedding[PAD] = 0
        return [dembedding, dfilters, dtop.sum(0), pooled.T @ dhidden, dhidden.sum(0), hidden.T @ dz, np.array([dz.sum()], np.float32)]

    def fit(self, texts: list[bytes], target: np.ndarray, weight: np.ndarray, seed: int = 2) -> None:
        """Learn the chunk logits by Adam, from every chunk of the documents; each document has its weight."""
        rng = np.random.default_rng(seed)
        values = [padded(t) for t in texts]
        orders = [rng.permutation((len(v) - (WIDTH - STRIDE)) // SPAN - 1) for v in values]
        counts = np.array([len(o) for o in orders])
        takes = np.minimum(counts, np.maximum(CHUNKS, -(-counts // EPOCHS)))
        owner = np.repeat(np.arange(len(values)), takes)
        goals = target[owner].astype(np.float32)
        weights = ((weight / takes)[owner] * takes.mean()).astype(np.float32)
        first = [np.zeros_like(w) for w in self.weights()]
        second = [np.zeros_like(w) for w in self.weights()]
        step = 0
        for epoch in range(EPOCHS):
            taken = np.concatenate([o[(epoch * n + np.arange(n)) % len(o)] for o, n in zip(orders, takes)]) * SPAN
            order = rng.permutation(len(owner))
            rate = RATE * (1 - epoch / EPOCHS)
            for at in range(0, len(order), BATCH):
                some, step = order[at : at + BATCH], step + 1
                chunks = np.stack([values[d][i : i + 2 * SPAN + WIDTH - STRIDE] for d, i in zip(owner[some], taken[some])])
                for w, g, a, b in zip(self.weights(), self.gradients(chunks, goals[some], weights[some]), first, second):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    w -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def fit_combination(self, features: np.ndarray, target: np.ndarray, weight: np.ndarray) -> None:
        """Logistic regression of the documents' features, by Newton steps with a small penalty."""
        w = np.zeros(features.shape[1])
        penalty = 1e-2 * np.eye(len(w))
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
            gradient = features.T @ (weight * (p - target)) + penalty @ w
            hessian = (features * (weight * p * (1 - p))[:, None]).T @ features + penalty
            w -= np.linalg.solve(hessian, gradient)
        self.combine = w


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", documents: int = DOCUMENTS) -> DataFrame:
    """(id, label, text): the bounded sample of documents to learn from, with their whole texts.

    Of the labelled documents outside the held-out fold, those with the ``documents`` least
    hashes of the id for each label 0 and 1. Ids are chosen before texts are touched.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(label).alias("label"))
    known = known.where(F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(FOLDS)) != 0).dropDuplicates(["id"])
    order = [F.xxhash64("id"), F.col("id")]
    chosen = known.where("label = 0").orderBy(*order).limit(documents).union(known.where("label = 1").orderBy(*order).limit(documents))
    some = docs.select(F.col(key).alias("own"), whole_text(text).alias("text")).join(F.broadcast(chosen), F.col("own") == F.col("id"))

    return some.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("int").alias("label"), "text")


def measured(documents: DataFrame, network: Network) -> DataFrame:
    """(id, label, features) of the documents of ``sample``, by ``network`` over their whole texts."""

    def make():
        def run(columns: dict) -> dict:
            texts = [t.encode() for t in columns["text"]]
            features = [network.features(network.logits(t), len(t)).tolist() for t in texts]
            return {"id": columns["id"], "label": columns["label"], "features": features}

        return run

    return map_batches(documents, make, "id bigint, label int, features array<double>")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", documents: int = DOCUMENTS) -> Network:
    """Fit the network on ``sample``, whose whole texts, of 2 * ``documents`` documents at most, reach the driver.

    The combination is fitted on the features that ``score`` has, of whole texts, which
    tasks compute. Labels weigh by the inverse of their share of the sample. Without
    labelled documents the scores are those of an untrained network.
    """
    sampled = cut_lineage(sample(docs, labels, key, text, label, documents))
    rows = sorted(sampled.collect(), key=lambda r: (r.id, r.text))
    network = Network()
    if not rows:
        return network

    def weighed(labels: list[int]) -> tuple[np.ndarray, np.ndarray]:
        target = np.array(labels, np.float64)
        share = np.array([max(1, (target == v).sum()) for v in (0, 1)]) / len(target)
        return target, 0.5 / share[target.astype(int)]

    network.fit([r.text.encode() for r in rows], *weighed([r.label for r in rows]))
    rows = sorted(measured(sampled, network).collect(), key=lambda r: (r.id, r.features))
    release(sampled)
    network.fit_combination(np.array([r.features for r in rows]), *weighed([r.label for r in rows]))
    return network


FIELDS = "held_out boolean, score double, predicted int"


def classify(docs: DataFrame, network: Network, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, name: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """Score every whole text; ``keep`` columns (all, if None) and struct ``name``.

    Fields: ``held_out`` (the id is in the fold that is never learned from), ``score`` (0 to
    1, higher: label 1 likelier), ``predicted`` (1 from ``threshold``). Only the text's
    bytes enter the score, all of them. A null or empty text is one chunk of padding and
    gets its score. Null ids count as fold of the empty text; repeated rows get the same
    score; other columns pass through.
    """

    def make():
        def run(keys: list, texts: list[str]) -> list[tuple]:
            rows = []
            for k, t in zip(keys, texts):
                score = network.score(t.encode())
                rows.append((fold_of(k) == 0, score, int(score >= threshold)))
            return rows

        return run

    return append(docs, make, [F.col(key), whole_text(text)], FIELDS, name, keep)
