"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

Base rules count words, symbols, repeated lines and repeated five-word windows.  Documents
that pass them are segmented into lines; each line has an indicator vector, the field has a
weight per (feature, label) and per label pair, and Viterbi decoding gives the best label
sequence.  A document is kept when the characters in content lines are at least
``min_content`` of the characters in all lines with a word.

Lines have no labels, documents do (``labels.quality``), and these bind their lines: most
characters of a good document are content, most of a bad one boilerplate.  All lines start with
their document's label, but notices and repeated lines, which start as boilerplate everywhere.
Then training (gradient ascent on the conditional likelihood, exact by forward-backward) and
relabelling take turns: a document's lines get the best sequence that its label allows, found by
raising a multiplier on its label until the share is right.  So lines may differ from their
document, and the field learns from the lines of bad documents what no rule here says.

The fit uses at most ``train_docs`` labelled documents, half of either label, in the order of a
hash of the id, of longer texts a window of ``train_chars`` characters at a drawn offset.  Without
labelled rows, all documents of the sample count as good.

Defined results: null or empty text has no words, so it fails the base rule and is not kept;
repeated rows get the same verdict; equal scores decode as content; of one id's several texts
those of the least hashes are learned; extra columns, also with names of results, are ignored
or, by ``keep_good``, passed on; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import bounded_batches, read, release_memory, spread, window_of

#: White space that parts words: space and the characters 9 to 13, nothing else.
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
#: Phrases, in lower case, that mark a notice.
NOTICES = ("licensed under", "licensed to", "under the mit license", "all rights reserved", "copyright", "cookie", "terms of use", "terms of service", "privacy policy")
CONTENT, BOILERPLATE = 0, 1
FEATURES, NOTICE, SEEN = 20, 1, 2
SPAN = 5


def count_base(text: str) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of a whole text."""
    words = WORDS.findall(text)
    n = len(words)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    repeat = repeated_words(words)
    return n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeat, n < 10 or 100 * repeat > 20 * n


def repeated_words(words: list[str]) -> int:
    """Words inside five-word windows that occur at least twice in the text."""
    n = len(words) - SPAN + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # Five numbers below 2**12 fit one key; otherwise windows are numbered pair by pair, also exactly.
    if len(number) < 1 << 12:
        key = ids[:n].copy()
        for i in range(1, SPAN):
            key = (key << 12) | ids[i : i + n]
    else:
        key = ids[:n]
        for i in range(1, SPAN):
            key = np.unique(key * len(number) + ids[i : i + n], return_inverse=True)[1]
    _, where, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[where] > 1)
    if not twice.size:
        return 0
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, twice, 1)
    np.add.at(marks, twice + SPAN, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def line_features(line: str, seen: bool) -> list[float]:
    """Indicators of one line that has a word."""
    words = WORDS.findall(line)
    n = len(words)
    lowered = line.lower()
    signs = sum(map(line.count, SYMBOLS)) / n
    upper = sum(map(str.isupper, words)) / n
    fresh = len(set(words)) / n if n >= 8 else 1
    short = sum(len(w) <= 3 for w in words) / n
    return [
        1.0,
        float(any(x in lowered for x in NOTICES)),
        float(seen),
        float(signs >= 0.1),
        float(signs >= 0.4),
        float(signs >= 0.9),
        float(upper >= 0.3),
        float(upper >= 0.8),
        float(line.count("!") >= 0.5 * n),
        float(line.count("/") >= 0.3 * n),
        float(sum(map(str.isdigit, words)) >= 0.2 * n),
        float(fresh < 0.4),
        float(fresh < 0.7),
        float(n < 4),
        float(n >= 8),
        float(n >= 25),
        float(short >= 0.25),
        float(sum(map(len, words)) >= 9 * n),
        float(line[-1:] in ".!?\""),
        float(line[:1].isupper()),
    ]


def line_table(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines, FEATURES) and sizes in characters of the lines with a word."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        if WORDS.search(line):
            rows.append(line_features(line, line in seen))
            sizes.append(len(line))
            seen.add(line)
    return np.array(rows).reshape(-1, FEATURES), np.array(sizes, np.int64)


def seed_labels(x: np.ndarray, good: bool) -> np.ndarray:
    """The document's label for all lines but notices and repeated lines."""
    rest = CONTENT if good else BOILERPLATE
    return np.where((x[:, NOTICE] > 0) | (x[:, SEEN] > 0), BOILERPLATE, rest)


def allowed(labels: np.ndarray, sizes: np.ndarray, good: bool, share: float = 0.5) -> bool:
    """Whether lines of these labels make a document good or bad."""
    return (sizes[labels == CONTENT].sum() >= share * sizes.sum()) == good


def bound_labels(emit: np.ndarray, move: np.ndarray, sizes: np.ndarray, good: bool) -> np.ndarray:
    """The best label sequence that the document's label allows, by raising a multiplier on that label."""
    wanted = CONTENT if good else BOILERPLATE
    for more in (0.0, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0):
        own = emit.copy()
        own[:, wanted] += more
        labels = viterbi(own, move)
        if allowed(labels, sizes, good):
            return labels
    return np.full(len(emit), wanted)


def viterbi(emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best label sequence for (lines, labels) emission and (labels, labels) transition scores."""
    arrive = list(zip(*move.tolist(), strict=True))
    steps = emit.tolist()
    score, back = steps[0], []
    for own in steps[1:]:
        best = [max((s + m, -i) for i, (s, m) in enumerate(zip(score, moves, strict=True))) for moves in arrive]
        back.append([-i for _, i in best])
        score = [b[0] + e for b, e in zip(best, own, strict=True)]
    path = [score.index(max(score))]
    for choice in reversed(back):
        path.append(choice[path[-1]])
    return np.array(path[::-1])


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis, keepdims=True))).squeeze(axis)


def ascend(tables: list[np.ndarray], gold: list[np.ndarray], weight: np.ndarray, move: np.ndarray, rounds: int, rate: float, decay: float) -> None:
    """Move the weights (FEATURES, 2) and transitions (2, 2) up the conditional likelihood of ``gold``."""
    total = max(1, sum(map(len, tables)))
    for _ in range(rounds):
        up_w, up_m = -decay * weight * total, -decay * move * total
        for x, y in zip(tables, gold, strict=True):
            emit = x @ weight
            n = len(x)
            left, right = emit.copy(), np.zeros_like(emit)
            for i in range(1, n):
                left[i] += _logsum(left[i - 1][:, None] + move, 0)
            for i in range(n - 2, -1, -1):
                right[i] = _logsum(move + (emit[i + 1] + right[i + 1])[None, :], 1)
            z = _logsum(left[-1], 0)
            up_w += x.T @ (np.eye(2)[y] - np.exp(left + right - z))
            if n > 1:
                pair = np.exp(left[:-1, :, None] + move + (emit[1:] + right[1:])[:, None, :] - z)
                np.add.at(up_m, (y[:-1], y[1:]), 1)
                up_m -= pair.sum(0)
        weight += rate * up_w / total * 4
        move += rate * up_m / total * 4


def train_crf(texts: list[str], good: list[bool], turns: int = 3, rounds: int = 14, rate: float = 0.7, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions from documents and their labels."""
    weight, move = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    rows = [(*line_table(t), g) for t, g in zip(texts, good, strict=True)]
    rows = [r for r in rows if len(r[0])]
    tables = [x for x, _, _ in rows]
    gold = [y if allowed(y, sizes, g) else np.full(len(x), CONTENT if g else BOILERPLATE) for x, sizes, g in rows for y in [seed_labels(x, g)]]
    for turn in range(turns):
        if turn:
            gold = [bound_labels(x @ weight, move, sizes, g) for x, sizes, g in rows]
        ascend(tables, gold, weight, move, rounds, rate, decay)
    return weight, move


def fit(docs: DataFrame, labels: DataFrame | None, train_docs: int = 240, train_chars: int = 8_000, id_col: str = "doc_id") -> tuple[np.ndarray, np.ndarray]:
    """Train on a bounded sample of labelled documents (of all, as good ones, without labels)."""
    own = docs.select(F.col(id_col).alias("id"), F.col("text").alias("text")).where("text IS NOT NULL")
    drawn = lambda df: df.orderBy(spread(F.col("id"), 9), F.xxhash64("text")).limit(train_docs // 2).select(window_of(F.col("text"), train_chars, 9).alias("text")).collect()
    texts, good = [], []
    if labels is not None:
        marked = labels.select(F.col("doc_id").alias("id"), "quality").where("id IS NOT NULL")
        for q in (0, 1):
            # the sample's ids, bounded by the limit, are broadcast
            ids = marked.where(F.col("quality") == q).select("id").distinct().orderBy(spread(F.col("id"), 9), "id").limit(train_docs // 2)
            found = drawn(own.join(F.broadcast(ids), "id", "left_semi"))
            texts += [r.text for r in found]
            good += [q == 1] * len(found)
    if not texts:
        texts = [r.text for r in drawn(own)]
        good = [True] * len(texts)
    return train_crf(texts, good)


def content_share(text: str, model: tuple[np.ndarray, np.ndarray]) -> float:
    """Characters in content lines of those in all lines with a word; 0 without such a line."""
    x, sizes = line_table(text)
    if not len(x):
        return 0.0
    return float(sizes[viterbi(x @ model[0], model[1]) == CONTENT].sum() / sizes.sum())


def judge(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], min_content: float = 0.5, id_col: str = "doc_id") -> DataFrame:
    """Base counts, the share of content and the verdict for every document."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"]
    schema = f"`{id_col}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in pdf["_text"]:
                base, part = count_base(text or ""), content_share(text or "", model)
                rows.append((*base, part, bool(not base[-1] and part >= min_content)))
            got = pd.DataFrame(rows, columns=names)
            got.insert(0, id_col, pdf["_id"].array)
            yield got
        release_memory()

    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col("text").alias("_text")).mapInPandas(run, schema)


def keep_good(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], min_content: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``judge`` keeps."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(at))
            stay = [not count_base(t)[-1] and content_share(t, model) >= min_content for t in texts]
            yield batch.filter(pa.array(stay, pa.bool_()))
        release_memory()

    return docs.mapInArrow(run, docs.schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judge(docs, fit(docs, read(spark, sf_dir, "labels")))
