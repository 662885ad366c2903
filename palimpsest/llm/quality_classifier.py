"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Each token owns a sparse ternary index vector drawn from a generator seeded by the token; a
token's word vector is the damped sum of its neighbours' index vectors over the sample.  A
document is the mean and mean square of its tokens' vectors, over the whole text.  A hidden
layer of rectified units and a logistic output are trained with Adam in numpy; a temperature,
chosen on a calibration fifth, scales the logit.

The fit uses at most ``train_docs`` labelled documents, taken in the order of a hash of the id, of
longer texts a window of ``train_chars`` characters at a drawn offset.  Scoring covers every
document, whole.

Defined results: null or empty text has a zero vector and gets the network's score for it;
repeated rows score alike; of one id's several texts that of the least hash is learned; equal
scores are no ties, since each row stands alone; labels without a quality are ignored; extra columns are ignored;
with labels of one kind only the score is that constant, without any labels 0.5.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import bounded_batches, crc_mod, read, release_memory, spread, window_of

TOKENS = re.compile(r"\w+|[^\w\s]+")
VOCABULARY, DIM, NONZERO, WINDOW = 20_000, 32, 6, 2
#: Shapes that stand for tokens outside the vocabulary, and the mark of an immediate repetition.
SHAPES = ("<lower>", "<title>", "<upper>", "<digits>", "<signs>", "<mixed>", "<again>")


def shape(token: str) -> str:
    if token.islower():
        return "<lower>"
    if token.istitle():
        return "<title>"
    if token.isupper():
        return "<upper>"
    if token.isdigit():
        return "<digits>"
    return "<mixed>" if token[0].isalnum() else "<signs>"


def index_vector(token: str) -> np.ndarray:
    rng = np.random.default_rng(zlib.crc32(token.encode()))
    out = np.zeros(DIM, np.float32)
    out[rng.choice(DIM, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
    return out


@dataclass
class Model:
    numbers: dict[str, int]
    vectors: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float = 1.0

    def ids(self, text: str) -> np.ndarray:
        tokens = TOKENS.findall(text)
        get, by_shape = self.numbers.get, self.numbers
        out = np.fromiter([n if (n := get(t)) is not None else by_shape[shape(t)] for t in tokens], np.int32, len(tokens))
        if len(tokens) > 1:
            out[1:][[a == b for a, b in zip(tokens, tokens[1:], strict=False)]] = by_shape["<again>"]
        return out

    def pooled(self, text: str) -> np.ndarray:
        ids = self.ids(text)
        total = np.zeros(2 * DIM, np.float64)
        for i in range(0, len(ids), 1 << 14):
            total += self.vectors[ids[i : i + (1 << 14)]].sum(0)
        return total / max(1, len(ids))

    def logits(self, x: np.ndarray) -> np.ndarray:
        center, scale, w1, b1, w2, b2 = self.layers
        return np.maximum((x - center) / scale @ w1 + b1, 0) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def word_vectors(streams: list[np.ndarray], size: int, index: np.ndarray) -> np.ndarray:
    """Damped, normalised sums of neighbours' index vectors, with their squares beside them."""
    keys = [np.concatenate([s[d:].astype(np.int64) * size + s[:-d] for s in streams if len(s) > d] or [np.empty(0, np.int64)]) for d in range(1, WINDOW + 1)]
    pairs, counts = np.unique(np.concatenate([*keys, *[k % size * size + k // size for k in keys]]), return_counts=True)
    out = np.zeros((size, DIM))
    for i in range(0, len(pairs), 1 << 17):
        rows, cols = np.divmod(pairs[i : i + (1 << 17)], size)
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        out[rows[starts]] += np.add.reduceat(index[cols] * np.sqrt(counts[i : i + (1 << 17)])[:, None], starts)
    out += index  # a token's own vector keeps rare tokens apart
    out /= np.linalg.norm(out, axis=1, keepdims=True) + 1e-9
    return np.hstack([out, out * out * DIM]).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, hidden: int = 24, epochs: int = 60, seed: int = 5) -> Model:
    streams = [TOKENS.findall(t) for t in texts]
    common = [t for t, _ in Counter(t for s in streams for t in s).most_common(VOCABULARY)]
    numbers = {t: i for i, t in enumerate([*SHAPES, *sorted(common)])}
    index = np.array([index_vector(t) for t in numbers])
    model = Model(numbers, np.zeros((len(numbers), 2 * DIM), np.float32), ())
    model.vectors = word_vectors([model.ids(t) for t in texts], len(numbers), index)
    x = np.array([model.pooled(t) for t in texts]).reshape(len(texts), 2 * DIM)
    y = labels.astype(float)
    rng = np.random.default_rng(seed)
    center, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(2 * DIM), np.ones(2 * DIM))
    p = [rng.normal(0, (2 / (2 * DIM)) ** 0.5, (2 * DIM, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(())]
    if len(set(labels.tolist())) < 2:
        model.layers = (center, scale, p[0] * 0, p[1], p[2] * 0, np.array(0.0 if not len(y) else 30.0 * (2 * y[0] - 1)))
        return model
    calibrate = rng.random(len(x)) < 0.2
    xs = (x - center) / scale
    rows = np.flatnonzero(~calibrate)
    first, second, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for _ in range(epochs):
        rng.shuffle(rows)
        for i in range(0, len(rows), 64):
            b, step = rows[i : i + 64], step + 1
            a = np.maximum(xs[b] @ p[0] + p[1], 0)
            error = (1 / (1 + np.exp(-(a @ p[2] + p[3]))) - y[b]) / len(b)
            back = error[:, None] * p[2] * (a > 0)
            grads = [xs[b].T @ back + 1e-3 * p[0], back.sum(0), a.T @ error + 1e-3 * p[2], error.sum()]
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] - 0.003 * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model.layers = (center, scale, *p)
    if calibrate.any():
        z, t = model.logits(x[calibrate]), y[calibrate]
        grid = np.exp(np.linspace(-1.0, 1.6, 40))
        model.temperature = float(grid[np.argmin([np.mean(np.logaddexp(0, z / g) - t * z / g) for g in grid])])
    return model


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, train_docs: int = 3_000, train_chars: int = 20_000) -> Model:
    """Train on the bounded sample; ``learnable`` is a condition on ``id`` that admits a label."""
    sample = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("quality")).where(learnable & F.col("id").isNotNull() & F.col("quality").isNotNull())
    sample = sample.orderBy(spread(F.col("id"), 6), "id", "quality").limit(train_docs)
    sample = sample.groupBy("id", "quality").agg(F.count("*").alias("times")).drop("times")
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.col("doc_id").alias("id"), F.struct(F.xxhash64(text).alias("draw"), window_of(text, train_chars, 6).alias("text")).alias("t"))
    # one text of each id and label, so at most as many rows as the limit says
    found = own.join(F.broadcast(sample), "id").groupBy("id", "quality").agg(F.min("t").alias("t"))
    rows = sorted(found.select("id", "t.text", "quality").collect())
    return train([r.text for r in rows], np.array([r.quality for r in rows], int))


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id") -> DataFrame:
    """id, score and predicted for every document."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for pdf in batches:
            s = own.scores(np.array([own.pooled(t or "") for t in pdf["text"]]).reshape(len(pdf), 2 * DIM))
            yield pd.DataFrame({id_col: pdf["id"].array, "score": s, "predicted": (s >= threshold).astype(np.int32)})
        release_memory()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col("text").alias("text")).mapInPandas(run, f"{id_col} {kind}, score double, predicted int")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"), crc_mod(F.col("id"), 4) != 2)
    return score(docs, model).select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")
