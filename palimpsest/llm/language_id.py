"""Language identification: a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes are cut into windows of ``SPAN`` bytes, all of them read.  In every
window one recurrence runs from the left and one from the right, each from a zero state; the
two states at a byte give that position's label distribution.  A document's probabilities are
the means over all its positions.  Training is backpropagation through time in numpy with
Adam on windows of a bounded, documented sample: at most ``per_language`` texts of each
language, taken by a hash of the id.

Defined results: null text and text without a letter give ``und`` with score 1; repeated rows
agree; of equally likely languages the first by name is told; null languages are never learned;
with no learnable row every text is ``und``; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import bounded_batches, crc_mod, read, release_memory, window_of

SPAN, HIDDEN, EMBED = 128, 8, 6
LANES = 2048


@dataclass
class Model:
    """Index 0 of each array runs from the left, index 1 from the right."""

    languages: list[str]
    embed: np.ndarray = field(default=None)  # (2, 256, E): a byte's vector
    project: np.ndarray = field(default=None)  # (2, E + 1, 3H): input weights, biases last
    recur: np.ndarray = field(default=None)  # (2, H, 3H)
    emit: np.ndarray = field(default=None)  # (2, H, L)
    bias: np.ndarray = field(default=None)  # (L,)

    @property
    def table(self) -> np.ndarray:
        """(2, 256, 3H): what each byte adds to the gates and the candidate."""
        return self.embed @ self.project[:, :EMBED] + self.project[:, EMBED:]


def gates(x: np.ndarray, u: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Update and reset gates (2, B, 2H), recurrent part and candidate (2, B, H)."""
    s = h @ u
    zr = np.tanh((x[..., : 2 * HIDDEN] + s[..., : 2 * HIDDEN]) * np.float32(0.5))
    zr *= np.float32(0.5)
    zr += np.float32(0.5)
    own = s[..., 2 * HIDDEN :]
    return zr, own, np.tanh(x[..., 2 * HIDDEN :] + zr[..., HIDDEN:] * own)


def both_ways(windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(2, B, T): the windows, and each one's first ``sizes`` bytes reversed."""
    at = np.maximum(sizes[:, None] - 1 - np.arange(windows.shape[1]), 0)
    return np.stack([windows, np.take_along_axis(windows, at, 1)])


def position_probabilities(model: Model, windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over each window's positions of the label distributions there: (B, L).

    Arrays are (direction, feature, window), so that each operation runs along windows.  One
    product per step gives both gates, the recurrent part and the input part of the candidate;
    the gates' halved arguments make sigmoids of tanh.
    """
    count, span = windows.shape
    x = np.ascontiguousarray(both_ways(windows, sizes).transpose(2, 0, 1))
    h8, two = HIDDEN, 2 * HIDDEN
    weight = np.zeros((2, 4 * h8, h8 + EMBED + 1), np.float32)
    weight[:, : 3 * h8, :h8] = np.swapaxes(model.recur, 1, 2)
    weight[:, :two, h8:] = np.swapaxes(model.project[:, :, :two], 1, 2)
    weight[:, 3 * h8 :, h8:] = np.swapaxes(model.project[:, :, two:], 1, 2)
    weight[:, :two] *= np.float32(0.5)
    embed = [np.ascontiguousarray(e.T) for e in model.embed]
    emit = np.ascontiguousarray(np.swapaxes(model.emit, 1, 2))
    state = np.zeros((2, h8 + EMBED + 1, count), np.float32)
    state[:, -1] = 1
    s, n = np.empty((2, 4 * h8, count), np.float32), np.empty((2, h8, count), np.float32)
    h = state[:, :h8]
    scores = np.empty((span, 2, len(model.languages), count), np.float32)
    for t in range(span):
        for d in (0, 1):
            np.take(embed[d], x[t, d], axis=1, out=state[d, h8 : h8 + EMBED], mode="clip")
        np.matmul(weight, state, out=s)
        zr = s[:, :two]
        np.tanh(zr, out=zr)
        zr += 1
        zr *= np.float32(0.5)
        np.multiply(zr[:, h8:], s[:, two : 3 * h8], out=n)
        n += s[:, 3 * h8 :]
        np.tanh(n, out=n)
        h -= n
        h *= zr[:, :h8]
        h += n
        np.matmul(emit, h, out=scores[t])
    if (sizes == span).all():
        z = scores[:, 0] + scores[::-1, 1]
    else:
        at = np.maximum(sizes[None, :] - 1 - np.arange(span)[:, None], 0)
        z = scores[:, 0] + np.take_along_axis(scores[:, 1], at[:, None], 0)
    z += model.bias[:, None]
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    if not (sizes == span).all():
        z *= (np.arange(span)[:, None] < sizes)[:, None]
    return z.sum(0).T


def train(texts: list[bytes], labels: list[str], rounds: int = 220, batch: int = 128, span: int = 48, rate: float = 0.02, seed: int = 7) -> Model:
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    model = Model(languages, rng.normal(0, 0.7, (2, 256, EMBED)).astype(np.float32), np.concatenate([rng.normal(0, EMBED**-0.5, (2, EMBED, 3 * HIDDEN)), np.zeros((2, 1, 3 * HIDDEN))], 1).astype(np.float32), rng.normal(0, HIDDEN**-0.5, (2, HIDDEN, 3 * HIDDEN)).astype(np.float32), rng.normal(0, 0.3, (2, HIDDEN, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    by_language = {g: [t for t, own in zip(texts, labels, strict=True) if own == g and t] for g in languages}
    by_language = {g: own for g, own in by_language.items() if own}
    if len(by_language) < 2:
        return model
    names = sorted(by_language)
    params = [model.embed, model.project, model.recur, model.emit, model.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        windows, gold = np.zeros((batch, span), np.uint8), np.empty(batch, np.int64)
        sizes = np.empty(batch, np.int64)
        for b in range(batch):
            g = names[b % len(names)]
            text = by_language[g][rng.integers(len(by_language[g]))]
            start = rng.integers(max(1, len(text) - span + 1))
            part = text[start : start + span]
            windows[b, : len(part)] = np.frombuffer(part, np.uint8)
            sizes[b], gold[b] = len(part), languages.index(g)
        for k, g in enumerate(gradients(model, windows, sizes, gold)):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] -= (rate * (1 - step / (rounds + 1)) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def gradients(model: Model, windows: np.ndarray, sizes: np.ndarray, gold: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross-entropy over positions, through time in both directions."""
    count, span = windows.shape
    x, table = both_ways(windows, sizes), model.table
    h, kept = np.zeros((2, count, HIDDEN), np.float32), []
    states = np.empty((span, 2, count, HIDDEN), np.float32)
    for t in range(span):
        step = np.stack([table[d][x[d, :, t]] for d in (0, 1)])
        zr, own, n = gates(step, model.recur, h)
        kept.append((h, zr, own, n))
        h = n + zr[..., :HIDDEN] * (h - n)
        states[t] = h
    at = np.maximum(sizes[None, :] - 1 - np.arange(span)[:, None], 0)[..., None]
    mirrored = np.take_along_axis(states[:, 1], at, 0)
    z = states[:, 0] @ model.emit[0] + mirrored @ model.emit[1] + model.bias
    z -= z.max(-1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(-1, keepdims=True)
    z[:, np.arange(count), gold] -= 1
    z *= ((np.arange(span)[:, None] < sizes) / max(1, sizes.sum()))[..., None]
    z = z.astype(np.float32)
    g_emit = np.stack([np.einsum("tbh,tbl->hl", states[:, 0], z), np.einsum("tbh,tbl->hl", mirrored, z)])
    g_state = np.zeros_like(states)
    g_state[:, 0] = z @ model.emit[0].T
    back = (z @ model.emit[1].T) * (np.arange(span)[:, None] < sizes)[..., None]
    for b in range(span):  # the mirrored position is its own inverse inside a window
        ok = b < sizes
        g_state[(sizes - 1 - b)[ok], 1, np.flatnonzero(ok)] = back[b, ok]
    g_table, g_recur = np.zeros_like(table), np.zeros_like(model.recur)
    g_h = np.zeros((2, count, HIDDEN), np.float32)
    for t in range(span - 1, -1, -1):
        h, zr, own, n = kept[t]
        z_, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        g = g_h + g_state[t]
        g_n = g * (1 - z_) * (1 - n * n)
        g_zr = np.concatenate([g * (h - n), g_n * own], -1) * zr * (1 - zr)
        g_s = np.concatenate([g_zr, g_n * r], -1)
        g_x = np.concatenate([g_zr, g_n], -1)
        for d in (0, 1):
            np.add.at(g_table[d], x[d, :, t], g_x[d])
        g_recur += np.swapaxes(h, 1, 2) @ g_s
        g_h = g * z_ + g_s @ np.swapaxes(model.recur, 1, 2)
    g_embed = g_table @ np.swapaxes(model.project[:, :EMBED], 1, 2)
    g_project = np.concatenate([np.swapaxes(model.embed, 1, 2) @ g_table, g_table.sum(1, keepdims=True)], 1)
    return [g_embed, g_project, g_recur, g_emit, z.sum((0, 1))]


def classify(model: Model, texts: list[bytes]) -> np.ndarray:
    """Probabilities of every text, the means over all its bytes."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    whole = -(-sizes // SPAN)
    owner = np.repeat(np.arange(len(texts)), whole)
    starts = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(whole) - whole) * SPAN, whole) + np.arange(len(owner)) * SPAN
    ends = np.minimum(starts + SPAN, np.cumsum(sizes)[owner])
    flat = np.frombuffer(b"".join(texts) + bytes(SPAN), np.uint8)
    out = np.zeros((len(texts), len(model.languages)))
    order = np.argsort(starts - ends, kind="stable")  # full windows first
    for i in range(0, len(order), LANES):
        part = order[i : i + LANES]
        windows = flat[starts[part][:, None] + np.arange(SPAN)]
        np.add.at(out, owner[part], position_probabilities(model, windows, ends[part] - starts[part]))
    return out / np.maximum(sizes, 1)[:, None]


def fit(docs: DataFrame, learnable: Column, per_language: int = 300, train_chars: int = 2_000, max_languages: int = 200, id_col: str = "doc_id") -> Model:
    """Train on at most ``per_language`` texts of each of the ``max_languages`` most frequent languages.

    Of a longer text a window of ``train_chars`` characters at a drawn offset is learned.  Rows are
    drawn by a hash of id and text, one for each draw, so repeated rows are one and the driver gets
    a bounded sample.
    """
    own = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("id", F.col(id_col)).where(learnable)
    own = own.select("lang", "text", F.pmod(F.xxhash64(F.col("id").cast("string"), "text", F.lit(3)), F.lit(1 << 30)).alias("draw"))
    # about how many different rows each has: repeats don't thin out its draws
    often = own.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages)
    # as many rows as the limit says: about twice as many draws as are wanted stay of each language
    wanted = often.select("lang", (F.lit(float(1 << 30)) * 2 * per_language / F.col("n")).alias("below"))
    drawn = own.join(F.broadcast(wanted), "lang").where(F.col("draw") < F.col("below"))
    rows = drawn.groupBy("lang", "draw").agg(F.min(window_of(F.col("text"), train_chars, 3)).alias("text")).collect()
    taken: dict[str, int] = {}
    texts, labels = [], []
    for r in sorted(rows, key=lambda r: (r.draw, r.lang)):
        if taken.setdefault(r.lang, 0) < per_language:
            taken[r.lang] += 1
            texts.append(r.text.encode())
            labels.append(r.lang)
    return train(texts, labels)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """id, lang_pred and score (the pooled probability of that language) for every document."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            names = np.full(len(texts), "und", object)
            scores = np.ones(len(texts))
            rows = [i for i, t in enumerate(texts) if own.languages and any(map(str.isalpha, t))]
            while rows:
                part, size = [], 0
                while rows and (not part or size < 1 << 21):
                    part.append(rows.pop())
                    size += len(texts[part[-1]])
                p = classify(own, [texts[i].encode() for i in part])
                best = p.argmax(1)
                names[part] = np.array(own.languages, object)[best]
                scores[part] = np.clip(p[np.arange(len(part)), best], 0, 1)
            yield pd.DataFrame({id_col: pdf["id"].array, "lang_pred": names, "score": scores})
        release_memory()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col("text").alias("text")).mapInPandas(run, f"{id_col} {kind}, lang_pred string, score double")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, crc_mod(F.col("id"), 3) != 1)
    return identify(docs, model).select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
