"""N-gram Jaccard join with adaptive multi-match prefixes, and its connected components.

A document's set holds the 64-bit hashes of its distinct five-word shingles.  Documents of
equal sets are one node (a 128-bit digest), so copies are compared once.  All sets are ordered
alike, by document frequency, then by hash.  If sets of sizes n and m link, they share at least
a = ceil(t (n + m) / (1 + t)) elements, and then the first n - a + l and m - a + l elements
share at least l.  Each document picks its l from an estimate of cost: an element more costs
the rows that hold it, and each further match that is asked for leaves ``DECAY`` of the
candidates, whose sets would be verified whole.  It puts out as many elements as its l and the
smallest possible partner need; a pair counts those within the two lengths above, for the lesser
l, and is verified on whole sets if it has l of them and could still reach a.

Frequencies come from all documents: every block of shingles sends its distinct ones in buckets
of hashes, and each bucket adds them up; elements of ``LEAST_DF`` or more are known by
frequency, the others count as equally rare.  Up to ``FREQUENT`` of them are broadcast; beyond
that the elements of all sets are joined with their frequencies by shuffling, with equal
results.  Copies of one text in several blocks count several times; frequencies steer the order
and l, never the outcome.

Large groups of near copies cost no pair list.  While ``CROWD`` or more nodes of several
components share an element, nodes are paired in rounds with hubs, a few of the nodes that share
such elements and are of other components, and links join components.  The first round takes one
hub a node, every further one twice as many, up to ``LOOKS``; from then on a round that links few
of its pairs is the last.  Then the pairs of different components, and only those, are listed,
filtered as above, and verified.  No link between components can be missed.

Defined results: null text, or text without a word, has no shingles and is linked with nothing;
fewer than five words are one shingle; equal texts, also under equal ids, are linked; a null id
is in its component but never names it unless all ids there are null; extra columns are ignored;
an empty table gives no rows.  Ties in frequency are broken by hash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import bounded_batches, materialize, read, release_memory
from palimpsest.llm.spans import of_document, same_document

SHINGLE, PERCENT = 5, 80
#: Shingles that a task holds at once; those of one bucket; bytes of text for each, about.
BLOCK_TOKENS, BUCKET_TOKENS, TEXT_BYTES = 500_000, 1_000_000, 6
LEAST_DF, FREQUENT = 4, 2_000_000
#: Greatest l; elements of unknown frequency that a set shares with unrelated sets; what one more match leaves of those.
LEVELS, PRIOR, DECAY = 16, 0.01, 0.5
#: Nodes that share an element and are worth a round; most hubs a node; the last round links less than one in ``WORTH`` pairs.
CROWD, LOOKS, WORTH = 32, 8, 20
BROADCAST_ROWS, BROADCAST_IDS = 200_000, 1_000_000
#: A prefix element on its way to its bucket: half of the node's digest stands for the node.
ELEMENT = np.dtype([("token", "<u8"), ("short", "<i8"), ("n", "<i4"), ("pos", "<i4"), ("ell", "<i1")])
#: Words are hashed as polynomials of their bytes modulo 2**64, in pieces of about this many bytes.
PIECE = 1 << 17
BASE = 0x9E3779B97F4A7C15
IN_WORD = np.ones(256, bool)
IN_WORD[[32, 9, 10, 11, 12, 13]] = False
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


POWERS, INVERSES = _powers(BASE, PIECE), _powers(pow(BASE, -1, 2**64), PIECE)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _piece_hashes(piece: bytes) -> np.ndarray:
    """A hash of each word: the difference of two running sums, moved to the word's start."""
    n = len(piece)
    data = np.frombuffer(piece, np.uint8)
    up, down = (POWERS, INVERSES) if n <= PIECE else (_powers(BASE, n), _powers(pow(BASE, -1, 2**64), n))
    word = np.zeros(n + 2, bool)
    word[1:-1] = IN_WORD[data]
    edges = np.flatnonzero(word[1:] != word[:-1])
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[:n], out=sums[1:])
    starts, ends = edges[::2], edges[1::2]
    return _mixed((sums[ends] - sums[starts]) * down[starts])


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word, A-Z lower-cased; pieces end where a word does."""
    data = text.encode().lower()
    if len(data) <= PIECE:
        return _piece_hashes(data)
    out, at = [], 0
    while at < len(data):
        end = SPACE.search(data, at + PIECE)
        end = end.start() if end else len(data)
        out.append(_piece_hashes(data[at:end]))
        at = end
    return np.concatenate(out)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    h = word_hashes(text or "")
    if not len(h):
        return h
    span = min(SHINGLE, len(h))
    n = len(h) - span + 1
    acc = np.full(n, span, np.uint64)
    for i in range(span):
        acc = (acc ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return np.unique(acc)


def node_of(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def short_of(node: bytes) -> int:
    return int.from_bytes(node[:8], "little", signed=True)


def bucket_bits(docs: DataFrame) -> int:
    """Buckets, as a power of two: each has about ``BUCKET_TOKENS`` shingles, whatever the input."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(4, (size // (TEXT_BYTES * BUCKET_TOKENS)).bit_length())


def in_buckets(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Bucket numbers and their slices of ascending keys: a bucket is the first ``bits`` bits."""
    ends = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    for bucket, (a, b) in enumerate(zip([0, *ends.tolist()], [*ends.tolist(), len(keys)], strict=True)):
        if b > a:
            yield bucket, slice(a, b)


def fingerprint(tokens: np.ndarray, bits: int) -> np.ndarray:
    """What frequencies know of a shingle: its bucket and 32 bits more."""
    return tokens >> np.uint64(32 - bits)


def profile(docs: DataFrame, bits: int) -> DataFrame:
    """Rows (doc_id, text_key, n, node, short) of documents, and rows (token, df) of frequent fingerprints.

    Both come from one pass: blocks of shingles and the documents' rows go through one shuffle.
    """
    kind = docs.schema["doc_id"].dataType
    own = "doc_id string, text_key long, n int, node binary, short long"  # ids as text: pandas has no long with nulls

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, size, seen = [], 0, set()

        def report() -> pd.DataFrame:
            tokens, df = np.unique(np.concatenate(block), return_counts=True)
            rest = (fingerprint(tokens, bits) & np.uint64(0xFFFFFFFF)).astype("<u4")
            parts = [(b, rest[at].tobytes(), df[at].astype("<u4").tobytes() if (df[at] > 1).any() else b"") for b, at in in_buckets(tokens, bits)]
            got = pd.DataFrame(parts, columns=["bucket", "tokens", "counts"])
            return got.assign(doc_id=None, text_key=0, n=0, node=None, short=0)

        for pdf in batches:
            rows = []
            for doc_id, key, text in zip(pdf["doc_id"].array, pdf["text_key"], pdf["text"], strict=True):
                tokens = shingles(text)
                node = node_of(tokens)
                rows.append((doc_id, key, len(tokens), node, short_of(node), -1 - key % (1 << bits)))
                if len(tokens) and node not in seen:
                    seen.add(node)
                    block.append(tokens)
                    size += len(tokens)
                if size >= BLOCK_TOKENS:
                    yield report()
                    block, size, seen = [], 0, set()
            yield pd.DataFrame(rows, columns=["doc_id", "text_key", "n", "node", "short", "bucket"]).assign(tokens=None, counts=None)
        if block:
            yield report()
        release_memory()

    def add_up(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            return pdf[["doc_id", "text_key", "n", "node", "short"]].assign(token=0, df=0)
        tokens = [np.frombuffer(t, "<u4") for t in pdf["tokens"]]
        counts = [np.frombuffer(c, "<u4") if c else np.ones(len(t), "<u4") for t, c in zip(tokens, pdf["counts"], strict=True)]
        token, counts = np.concatenate(tokens), np.concatenate(counts)
        order = np.argsort(token, kind="stable")
        token, counts = token[order], counts[order]
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        df = np.add.reduceat(counts.astype(np.int64), starts)
        often = df >= LEAST_DF
        token = (np.uint64(key[0]) << np.uint64(32)) | token[starts][often].astype(np.uint64)
        return pd.DataFrame({"doc_id": None, "text_key": 0, "n": 0, "node": None, "short": 0, "token": token.view(np.int64), "df": df[often]})

    keyed = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    sent = keyed.mapInPandas(run, f"{own}, bucket int, tokens binary, counts binary")
    return sent.groupBy("bucket").applyInPandas(add_up, f"{own}, token long, df long").withColumn("doc_id", F.col("doc_id").cast(kind))


def first_prefix(size: int) -> int:
    """Length of the prefix for l = 1 and the smallest possible partner."""
    return size - (PERCENT * size + 99) // 100 + 1


def choose_level(df: np.ndarray) -> int:
    """l of least estimated cost for a set whose elements, in order, are in ``df`` sets (1: unknown, few).

    Partners are taken to be of the same size, as near copies mostly are: what they share stands
    in a prefix of about half the length that the smallest partner needs.
    """
    size = len(df)
    first = size - (2 * PERCENT * size + 99 + PERCENT) // (100 + PERCENT) + 1
    levels = np.arange(min(LEVELS, size - first_prefix(size) + 1))
    rows = np.cumsum(df[: first + len(levels) - 1])[first - 1 :]
    candidates = (df[:first] - 1).sum() + PRIOR * first
    return 1 + int(np.argmin(rows + size * candidates * DECAY**levels))


def elements(tokens: np.ndarray, df: np.ndarray, short: int) -> tuple[np.ndarray, np.ndarray]:
    """A set's prefix elements, and which of them have a known frequency."""
    if (df > 1).any():
        order = np.lexsort((tokens, df))
        tokens, df = tokens[order], df[order]
    ell = choose_level(df)
    length = first_prefix(len(tokens)) + ell - 1
    out = np.empty(length, ELEMENT)
    out["token"], out["short"], out["n"], out["pos"], out["ell"] = tokens[:length], short, len(tokens), np.arange(1, length + 1), ell
    return out, df[:length] > 1


SENT = "bucket int, blob binary, token long, short long, n int, pos int, ell int"
HELD = "token long, short long, n int, pos int, ell int, known boolean"


def send(found: Iterator[tuple[np.ndarray, np.ndarray]], bits: int) -> Iterator[pd.DataFrame]:
    """Rows to be shuffled: elements of unknown frequency packed by bucket, the others singly, spread over groups."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> Iterator[pd.DataFrame]:
        own, known = (np.concatenate(x) for x in zip(*parts, strict=True))
        cold = own[~known]
        cold = cold[np.argsort(cold["token"], kind="stable")]
        blobs = [(b, cold[at].tobytes()) for b, at in in_buckets(np.ascontiguousarray(cold["token"]), bits)]
        yield pd.DataFrame(blobs, columns=["bucket", "blob"]).assign(token=0, short=0, n=0, pos=0, ell=0)
        hot = own[known]
        if len(hot):
            mixed = (hot["token"] ^ hot["short"].view("<u8")) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)
            rows = pd.DataFrame({c: hot[c] for c in ("token", "short", "n", "pos", "ell")})
            yield rows.assign(token=hot["token"].view("<i8"), ell=hot["ell"].astype(int), bucket=-1 - mixed.astype(np.int64), blob=None)

    for part in found:
        parts.append(part)
        held += len(part[0])
        if held >= BLOCK_TOKENS // 2:
            yield from flush()
            parts, held = [], 0
    if parts:
        yield from flush()


def gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Distinct elements of a group; of unknown frequency only those that two or more nodes have."""
    if key[0] < 0:
        return pdf[["token", "short", "n", "pos", "ell"]].drop_duplicates(["token", "short"]).assign(known=True)
    own = np.concatenate([np.frombuffer(b, ELEMENT) for b in pdf["blob"]])
    own = own[np.lexsort((own["short"], own["token"]))]
    token = own["token"]
    again = np.r_[False, (token[1:] == token[:-1]) & (own["short"][1:] == own["short"][:-1])]
    own = own[~again]
    same = own["token"][1:] == own["token"][:-1]
    own = own[np.r_[False, same] | np.r_[same, False]]
    return pd.DataFrame({c: own[c] for c in ("short", "n", "pos")} | {"token": own["token"].view("<i8"), "ell": own["ell"].astype(int), "known": False})[["token", "short", "n", "pos", "ell", "known"]]


def prefixes(docs: DataFrame, frequent: DataFrame, bits: int) -> DataFrame:
    """(token, short, n, pos, ell, known): prefix elements of every distinct set that other sets may have."""
    if frequent.count() > FREQUENT:
        sent = _ranked_by_shuffle(docs, frequent, bits)
    else:
        # the count above bounds what is collected
        known = frequent.toArrow()
        tokens, df = known["token"].to_numpy(), known["df"].to_numpy()
        order = np.argsort(tokens)
        table = tokens[order].view(np.uint64), np.minimum(df[order], 2**31 - 1).astype(np.int32)
        del known, tokens, df, order
        shared = docs.sparkSession.sparkContext.broadcast(table)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tokens_of, df_of = shared.value
            seen: set[bytes] = set()

            def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for pdf in batches:
                    for text in pdf["text"]:
                        tokens = shingles(text)
                        if not len(tokens) or (node := node_of(tokens)) in seen:
                            continue
                        seen.add(node)
                        df = np.ones(len(tokens), np.int64)
                        if len(tokens_of):
                            own = fingerprint(tokens, bits)
                            at = np.minimum(np.searchsorted(tokens_of, own), len(tokens_of) - 1)
                            df = np.where(tokens_of[at] == own, df_of[at], 1).astype(np.int64)
                        yield elements(tokens, df, short_of(node))

            yield from send(found(), bits)
            release_memory()

        sent = docs.select("text").mapInPandas(run, SENT)
    return sent.groupBy("bucket").applyInPandas(gather, HELD)


def _ranked_by_shuffle(docs: DataFrame, frequent: DataFrame, bits: int) -> DataFrame:
    """The rows that ``prefixes`` shuffles, where frequencies are too many to be broadcast."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for pdf in batches:
            for text in pdf["text"]:
                tokens = shingles(text)
                if len(tokens) and (node := node_of(tokens)) not in seen:
                    seen.add(node)
                    yield pd.DataFrame({"short": short_of(node), "n": len(tokens), "own": tokens.view(np.int64), "token": fingerprint(tokens, bits).view(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for pdf in batches:
                for short, own, df in zip(pdf["short"], pdf["own"], pdf["df"], strict=True):
                    tokens = np.array(own, np.int64).view(np.uint64)
                    order = np.argsort(tokens)
                    yield elements(tokens[order], np.array(df, np.int64)[order], short)

        yield from send(found(), bits)

    rows = docs.select("text").mapInPandas(each, "short long, n int, own long, token long").join(frequent, "token", "left")
    sets = rows.groupBy("short", "n").agg(F.collect_set(F.struct("own", F.coalesce("df", F.lit(1)).alias("df"))).alias("x"))
    return sets.select("short", F.col("x.own").alias("own"), F.col("x.df").alias("df")).mapInPandas(run, SENT)


def _least_overlap(n: Column, m: Column) -> Column:
    """Elements that linked sets of these sizes share at least."""
    return F.ceil((n + m) * PERCENT / (100 + PERCENT))


def _may_link(x: str, y: str) -> Column:
    """Sizes allow a link, and the element is within both lengths for the lesser l."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    spare = F.least(f"{x}.ell", f"{y}.ell") - _least_overlap(n, m)
    near = (n * 100 >= m * PERCENT) & (m * 100 >= n * PERCENT)
    return near & (F.col(f"{x}.pos") <= n + spare) & (F.col(f"{y}.pos") <= m + spare)


def texts_of(ids: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(id, text) of these nodes, each once, written."""
    wanted = materialize(reps.join(ids.distinct(), "id").select("id", "doc_id", "text_key"))
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    found = docs.alias("l").join(wanted.alias("r"), of_document()).select("id", "text")
    return materialize(found.groupBy("id").agg(F.min("text").alias("text")))


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets link; the texts of a move to those of b, which hubs share."""
    pairs = pairs.select("a", "b")
    hubs = pairs.select("b").distinct()
    if pairs.count() <= BROADCAST_ROWS:
        pairs, hubs = F.broadcast(pairs), F.broadcast(hubs)
    # a row of either side may be repeated; links are made distinct
    left = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    right = hubs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lru_cache(maxsize=4)(shingles)
        for batch in batches:
            keep = []
            for ta, tb in zip(batch["ta"], batch["tb"], strict=True):  # a task holds one batch and a few sets at a time
                x, y = shingles(ta.as_py()), of(tb.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        release_memory()

    return materialize(left.join(right, "b").select("a", "b", "ta", "tb").mapInArrow(linked, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of (a, b): every node joins its least neighbour, edges are contracted, until none is left."""
    labels = None
    while True:
        step = edges.union(edges.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        step = materialize(step.select("node", F.least("node", "least").alias("comp")))
        if labels is None:
            labels = step
        else:
            labels = materialize(labels.join(step.select(F.col("node").alias("comp"), F.col("comp").alias("next")), "comp", "left").select("node", F.coalesce("next", "comp").alias("comp")))
        a, b = (step.select(F.col("node").alias(c), F.col("comp").alias(f"{c}2")) for c in ("a", "b"))
        edges = edges.join(a, "a").join(b, "b").where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        edges = materialize(edges.distinct())
        if edges.isEmpty():
            return labels


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (id, comp) after these links (a, b); nodes without a row are their own components."""
    if labels is None:
        return components(links).withColumnRenamed("node", "id")
    of = lambda c: labels.select(F.col("id").alias(c), F.col("comp").alias(f"{c}2"))
    edges = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a2", "a").alias("a"), F.coalesce("b2", "b").alias("b"))
    step = components(materialize(edges))
    # a node that was alone so far has a row only in ``step``, under its own name
    old = labels.join(step.select(F.col("node").alias("comp"), F.col("comp").alias("next")), "comp", "left")
    new = step.join(labels.select(F.col("id").alias("node")), "node", "left_anti").select(F.col("node").alias("id"), "comp")
    return materialize(old.select("id", F.coalesce("next", "comp").alias("comp")).unionByName(new))


def _relabelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the component of each id as ``comp``."""
    if labels is None:
        return rows.withColumn("comp", F.col("id"))
    small = labels.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(labels) if small else labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def crowd_classes(shared: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame | None:
    """(id, comp) of nodes that rounds link, among those that share elements with ``CROWD`` or more."""
    often = shared.where("known").groupBy("token").agg(F.count("*").alias("held")).where(F.col("held") >= CROWD).select("token")
    crowd = materialize(shared.where("known").join(often, "token", "left_semi"))
    if crowd.isEmpty():
        return None
    texts = texts_of(crowd.select("id"), docs, reps)
    labels, looks = None, 1
    while True:
        rows = _relabelled(crowd, labels)
        each = F.struct("id", "n", "pos", "ell", "comp")
        # the first hub of an element is the node with the fewest rarer elements, others are drawn
        draws = [F.min(F.struct(F.col("pos").cast("long").alias("draw") if i == 0 and looks == 1 else F.xxhash64("id", F.lit(looks + i)).alias("draw"), each.alias("hub"))).alias(f"d{i}") for i in range(looks)]
        hubs = rows.groupBy("token").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), *draws).where("c1 < c2")
        hubs = materialize(hubs.select("token", F.explode(F.array_distinct(F.array(*[F.col(f"d{i}.hub") for i in range(looks)]))).alias("hub")).select("token", "hub.*"))
        met = rows.alias("x").join(hubs.alias("h"), "token").where((F.col("x.comp") != F.col("h.comp")) & _may_link("x", "h"))
        met = met.groupBy(F.col("x.id").alias("a"), F.col("h.id").alias("b")).agg(F.count("*").alias("met"))
        # as many pairs of each node as there are looks; a node meets at most its elements' hubs
        best = F.slice(F.sort_array(F.collect_list(F.struct("met", "b")), asc=False), 1, looks)
        pairs = materialize(met.groupBy("a").agg(best.alias("best")).select("a", F.explode("best.b").alias("b")))
        found = verify(pairs, texts)
        n, tried = found.count(), pairs.count()
        if n:
            labels = _joined(labels, found)
        if not tried or (looks >= LOOKS and n * WORTH <= tried):
            return labels
        looks = min(2 * looks, LOOKS)


def link_classes(shared: DataFrame, docs: DataFrame, reps: DataFrame) -> DataFrame | None:
    """(id, comp) of all nodes that are linked, from prefix elements (token, id, n, pos, ell, known); None without links."""
    labels = crowd_classes(shared, docs, reps)
    rows = _relabelled(shared, labels)
    met = rows.alias("x").join(rows.alias("y"), "token").where((F.col("x.comp") < F.col("y.comp")) & _may_link("x", "y"))
    rest = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    met = met.groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b")).agg(F.count("*").alias("met"), F.max(F.least("x.ell", "y.ell")).alias("need"), F.min(rest).alias("rest"), F.max(_least_overlap(F.col("x.n"), F.col("y.n"))).alias("least"))
    listed = materialize(met.where((F.col("met") >= F.least("need", "least")) & (F.col("met") + F.col("rest") >= F.col("least"))).select("a", "b"))
    if listed.isEmpty():
        return labels
    found = verify(listed, texts_of(listed.select(F.col("a").alias("id")).union(listed.select("b")), docs, reps))
    return labels if found.isEmpty() else _joined(labels, found)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, group (of the component, null for empty sets) for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    bounded_batches(docs.sparkSession)
    bits = bucket_bits(docs)
    both = materialize(profile(docs, bits))
    rows = both.where("node IS NOT NULL").drop("token", "df")
    reps = rows.where("n > 0").groupBy("node").agg(F.min("short").alias("short"), F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "text_key")).alias("one"))
    reps = materialize(reps.select(F.monotonically_increasing_id().alias("id"), "node", "short", "least_id", "one.*"))
    held = materialize(prefixes(docs, both.where("node IS NULL").select("token", "df"), bits))
    # digests that agree in half are two nodes with the rows of both: candidates more, no link less
    ids = reps.select("id", "short")
    shared = materialize(held.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "short").drop("short"))
    labels = link_classes(shared, docs, reps)
    classes = reps.select("id", "node", "least_id", F.col("id").alias("comp")) if labels is None else reps.select("id", "node", "least_id").join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    named = classes.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    classes = materialize(classes.join(named, "comp").select("node", "component_id", F.col("comp").alias("group")))
    out = rows.join(classes, "node", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "group", "text_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of the least id stays.

    Empty documents are their own components.  The rows that go are joined to the documents;
    up to ``BROADCAST_ROWS`` of them no text is shuffled.
    """
    named = materialize(near_duplicates(docs).where("n_shingles > 0"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key")).alias("c")
    chosen = named.groupBy("group").agg(first).select("c.doc_id", "c.text_key", F.lit(True).alias("stays"))
    rows = named.groupBy("doc_id", "text_key").agg(F.count("*").alias("copies"))
    told = rows.alias("l").join(chosen.alias("r"), same_document(), "left").select("l.doc_id", "l.text_key", "copies", "stays")
    told = materialize(told.where("stays IS NULL OR copies > 1"))
    gone, repeated = told.where("stays IS NULL"), told.where("stays")
    if told.count() <= BROADCAST_ROWS:
        gone, repeated = F.broadcast(gone), F.broadcast(repeated)
    kept = docs.alias("l").join(gone.alias("r"), of_document(), "left_anti")
    if not told.where("stays").isEmpty():
        again = kept.alias("l").join(repeated.alias("r"), of_document(), "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.alias("l").join(repeated.alias("r"), of_document(), "left_anti").unionByName(again)
    return kept


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
