"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

Every pre-token is a row of a batch.  The leaves of its segment tree hold, for each live
pair of neighbouring symbols, ``rank * width + position``; an inner node holds the minimum
of its children.  The root is therefore the leftmost pair of the lowest rank.  One merge
changes at most three leaves (the merged pair, the one before it, the one that vanishes),
each repaired on its path to the root, so a pre-token of n bytes takes O(n log n) steps
however long it is.  Many trees of one width are advanced together with numpy.

Defined results: null text is the empty text (no ids); empty text gives no ids; repeated
rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import bounded_batches, read, release_memory

#: White space as the Unicode property has it, as the body of a character class.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A pre-token never crosses from one of these chunks into the next.
CHUNKS = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Pre-tokens that a generation of a cache holds, and characters that are encoded at once; a quarter as many leaves.
CACHE_ENTRIES, SLICE = 150_000, 1 << 22
NONE = np.iinfo(np.int64).max


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Recent:
    """A cache in two generations: what goes unused while ``limit`` others come in is forgotten."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def age(self) -> None:
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}

    def missing(self, keys: set[str]) -> set[str]:
        """The keys that are in neither generation; the others are young afterwards."""
        lacking = keys - self.young.keys()
        again = lacking & self.old.keys()
        self.young.update((k, self.old[k]) for k in again)
        return lacking - again


class SegmentTreeBPE:
    """Encoder and decoder for one byte-level BPE vocabulary file."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES, chars: int = SLICE):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, alphabet = spec["model"]["vocab"], byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.fine = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
        self.pieces = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for piece, i in vocab.items():
            self.pieces[i] = bytes(alphabet[c] for c in piece)
        for piece, i in self.special.items():
            self.pieces[i] = piece.encode()
        self.of_byte = np.zeros(256, np.int64)
        for c, b in alphabet.items():
            self.of_byte[b] = vocab[c]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.n = len(self.pieces)
        keys = np.array([vocab[a] * self.n + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.words, self.chunks = Recent(entries), Recent(entries)
        self.leaves = chars // 4

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair; NONE where there is no such merge or no neighbour."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge_all(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids (little-endian uint32) of words of 1 to ``width`` bytes, all trees side by side."""
        count = len(words)
        sizes = np.fromiter(map(len, words), np.int64, count)
        raw = np.zeros((count, width + 1), np.uint8)
        raw[np.arange(width + 1) < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        symbol = np.where(np.arange(width + 1) < sizes[:, None], self.of_byte[raw], -1)
        after = np.tile(np.arange(1, width + 2), (count, 1))
        before = np.tile(np.arange(-1, width), (count, 1))
        rank = self._rank(symbol[:, :-1], symbol[:, 1:])
        levels = [np.where(rank == NONE, NONE, rank * width + np.arange(width))]
        while levels[-1].shape[1] > 1:
            levels.append(np.minimum(levels[-1][:, 0::2], levels[-1][:, 1::2]))
        live = np.flatnonzero(levels[-1][:, 0] != NONE)
        while live.size:
            root = levels[-1][live, 0]
            at = root % width
            gone = after[live, at]
            follow = after[live, gone]
            symbol[live, at] = self.merged[root // width]
            symbol[live, gone] = -1
            after[live, at] = follow
            inside = follow <= width
            before[live[inside], follow[inside]] = at[inside]
            right = np.where(inside, symbol[live, np.minimum(follow, width)], -1)
            self._update(levels, live, at, self._rank(symbol[live, at], right), width)
            self._update(levels, live, gone, np.full(live.size, NONE), width)
            prior = before[live, at]
            has = prior >= 0
            if has.any():
                rows, prior = live[has], prior[has]
                self._update(levels, rows, prior, self._rank(symbol[rows, prior], symbol[rows, at[has]]), width)
            live = live[levels[-1][live, 0] != NONE]
        kept = symbol >= 0
        ids = symbol[kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(1)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    @staticmethod
    def _update(levels: list[np.ndarray], rows: np.ndarray, at: np.ndarray, rank: np.ndarray, width: int) -> None:
        inside = at < width
        if not inside.all():
            rows, at, rank = rows[inside], at[inside], rank[inside]
        levels[0][rows, at] = np.where(rank == NONE, NONE, rank * width + at)
        for low, high in zip(levels, levels[1:], strict=False):
            at = at >> 1
            high[rows, at] = np.minimum(low[rows, 2 * at], low[rows, 2 * at + 1])

    def learn(self, words: Iterable[str], into: dict[str, bytes]) -> None:
        """Put the ids of new pre-tokens in a cache."""
        by_width: dict[int, list[str]] = {}
        for w in words:
            n = len(w) if w.isascii() else len(w.encode())
            if n == 1:
                into[w] = self.of_byte[w.encode()[0]].astype("<u4").tobytes()
            else:
                by_width.setdefault(1 << (n - 1).bit_length(), []).append(w)
        for width, group in by_width.items():
            step = max(1, self.leaves // width)
            for i in range(0, len(group), step):
                part = group[i : i + step]
                into.update(zip(part, self.merge_all([w.encode() for w in part], width), strict=True))

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts in which special tokens' strings don't count."""
        split = [CHUNKS.findall(t) for t in texts]
        self.chunks.age()
        simple, fine = [], {}
        for c in self.chunks.missing(set().union(*split)):
            # letters, with a space before them or without, are one pre-token
            if c.isalpha() or (c[0] == " " and c[1:].isalpha()):
                simple.append(c)
            else:
                fine[c] = self.fine.findall(c)
        self.learn(simple, self.chunks.young)
        self.words.age()
        self.learn(self.words.missing(set().union(*fine.values())), self.words.young)
        word = self.words.young.__getitem__
        self.chunks.young.update((c, b"".join(map(word, ws))) for c, ws in fine.items())
        get = self.chunks.young.__getitem__
        return [b"".join(map(get, s)) for s in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers; special tokens' strings give their ids."""
        if self.special_re is None or not any(s in t for t in texts for s in self.special):
            return self.encode_plain(texts)
        parts = [self.special_re.split(t) for t in texts]
        plain = iter(self.encode_plain([p for ps in parts for p in ps[::2]]))
        return [b"".join(next(plain) if i % 2 == 0 else np.array(self.special[p], "<u4").tobytes() for i, p in enumerate(ps)) for ps in parts]

    def decode_bytes(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str, entries: int = CACHE_ENTRIES, chars: int = SLICE) -> SegmentTreeBPE:
    return SegmentTreeBPE(path, entries, chars)


def in_slices(texts: list[str], chars: int = SLICE) -> Iterator[list[str]]:
    """Consecutive runs of texts of about ``chars`` characters, so that memory stays bounded."""
    own: list[str] = []
    size = 0
    for t in texts:
        own.append(t)
        size += len(t)
        if size >= chars:
            yield own
            own, size = [], 0
    if own:
        yield own


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, entries: int = CACHE_ENTRIES, chars: int = SLICE) -> DataFrame:
    """Encode and decode every text: id, n_tokens, both digests and, with ``keep_ids``, ids and decoded text.

    ``entries`` and ``chars`` bound a worker's memory, never the result.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * keep_ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(tokenizer, entries, chars)
        for pdf in batches:
            out = []
            for texts in in_slices([t or "" for t in pdf["text"]], chars):
                for ids in model.encode(texts):
                    decoded = model.decode_bytes(ids).decode("utf-8", "replace")
                    row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
                    out.append(row + ((ids, decoded) if keep_ids else ()))
            got = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep_ids else [])])
            got.insert(0, id_col, pdf["id"].array)
            yield got
        release_memory()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, schema)


def production_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read(spark, sf_dir, "documents"), production_tokenizer())
