"""Benchmark decontamination by winnowing.

Words are lower-cased in A-Z and hashed; a k-gram's hash is the hash of k word hashes.  Of every
``w`` consecutive k-grams those with the minimum hash are fingerprints, so texts that share
``k + w - 1`` consecutive words share a fingerprint at the same offset; k = 5 and w = 6 cover
every window of 10 words.  Items of fewer words are one window each: for each such length m the
m-grams of all texts are fingerprints (k = m, w = 1).

Fingerprints of texts and items are joined on their hash.  A join match is extended: windows of
the item around the fingerprint are compared, word by word, with the text around it, and only
equal windows count.  The few words around a fingerprint that a window over it can reach travel
with it, so no text or item is read twice or shuffled.  Before a fingerprint becomes a row, it is
tested against a bit table of the items' fingerprints (a literal); false positives fall in the
join.  The item side is broadcast up to ``BROADCAST_BYTES`` and shuffled beyond.  Only DataFrame
expressions run on executors.

Defined results: null text, or text without words, has no words and no hits; items without
words have no windows; repeated rows (equal id and text) agree; repeated items count once by
id, items with null ids count as hits and in no list of items; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import materialize, read
from palimpsest.llm.spans import let, of_document, same_document

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, K = 10, 5
W = WINDOW - K + 1
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
TABLE_BITS = 24


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; ``lower`` alone where the text is ASCII."""
    own = F.coalesce(text, F.lit(""))
    low = F.when(F.length(own) == F.octet_length(own), F.lower(own)).otherwise(F.translate(own, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.filter(F.split(low, GAP), lambda x: x != "")


def grams(words: Column, k: int) -> Column:
    """Hashes of the k-grams of words that start at 0, 1, ..."""
    each = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
    whole = let(F.transform(words, lambda x: F.xxhash64(x)), each)
    return F.when(F.size(words) >= k, whole).otherwise(F.array().cast("array<bigint>"))


def minima(g: Column, w: int) -> Column:
    """Minimum of each ``w`` consecutive k-grams."""
    least = lambda i: F.least(*[F.get(g, i + j) for j in range(w)])
    return F.when(F.size(g) >= w, F.transform(F.sequence(F.lit(0), F.size(g) - w), least)).otherwise(F.array().cast("array<bigint>"))


def fingerprints(g: Column, w: int, test=None) -> Column:
    """Positions of the k-grams that are the minimum of some window of ``w``, as an int array.

    A k-gram is one if it equals the greatest of the minima of the windows it lies in.
    """
    none = F.array().cast("array<int>")
    if w == 1:
        return F.when(F.size(g) > 0, F.filter(F.sequence(F.lit(0), F.size(g) - 1), lambda i: test(F.get(g, i)) if test else F.lit(True))).otherwise(none)

    def positions(m: Column) -> Column:
        def chosen(i: Column) -> Column:
            top = F.greatest(*[F.get(m, F.when(i >= j, i - j)) for j in range(w)])
            own = F.get(g, i) == top
            return test(F.get(g, i)) & own if test else own

        return F.when(F.size(g) >= w, F.filter(F.sequence(F.lit(0), F.size(g) - 1), chosen)).otherwise(none)

    return let(minima(g, w), positions)


def bit_table(found: DataFrame):
    """A test against a bit table of the fingerprints in ``found``, with about 32 bits for each.

    The table is summed up in words of 64 bits, at most ``2**TABLE_BITS`` bits; beyond that only
    more false positives pass.
    """
    bits = max(10, min(TABLE_BITS, (32 * max(1, found.count()) - 1).bit_length()))
    at = F.col("fp").bitwiseAND((1 << bits) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(63).cast("int"))
    words = found.groupBy(F.shiftright(at, 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("value")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words["word"].to_numpy()] = words["value"].to_numpy()
    # numpy arrays become single literals, where lists would become one expression a value
    powers = F.lit(np.left_shift(np.int64(1), np.arange(64)))
    literal = F.lit(table)

    def test(h: Column) -> Column:
        place = h.bitwiseAND((1 << bits) - 1)
        return F.get(literal, F.shiftright(place, 6).cast("int")).bitwiseAND(F.get(powers, place.bitwiseAND(63).cast("int"))) != 0

    return test


def item_fingerprints(items: DataFrame, k: int, w: int, short: bool) -> DataFrame:
    """fp, item, lead, around: the item's words from ``lead`` before the fingerprint to the last that
    a window over it can reach; ``short`` items have exactly k words."""
    length, reach = k if short else WINDOW, w - 1
    own = items.where((F.size("words") == k) if short else (F.size("words") >= WINDOW))
    lead = lambda i: F.least(i, F.lit(reach))

    def marks(words: Column, g: Column) -> Column:
        return F.transform(fingerprints(g, w), lambda i: F.struct(F.get(g, i).alias("fp"), lead(i).alias("lead"), F.slice(words, i - lead(i) + 1, lead(i) + length).alias("around")))

    found = let(F.col("words"), lambda words: let(grams(words, k), lambda g: marks(words, g)))
    return own.select("item", F.explode_outer(found).alias("x")).where("x IS NOT NULL").select("x.fp", "item", "x.lead", "x.around")


def hits_of(docs: DataFrame, items: DataFrame, k: int, w: int, short: bool) -> DataFrame:
    """doc_id, text_key, item, start, size: occurrences of item windows in ``docs`` (doc_id, text_key, text)."""
    length, reach = k if short else WINDOW, w - 1
    found = materialize(item_fingerprints(items, k, w, short))
    test = bit_table(found)
    held = found.agg(F.sum(F.octet_length(F.concat_ws(" ", "around")) + 40).alias("bytes")).first().bytes or 0
    if held <= BROADCAST_BYTES:
        found = F.broadcast(found)

    def marked(words: Column, g: Column) -> Column:
        near = lambda i: F.slice(words, F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + length)
        return F.transform(fingerprints(g, w, test), lambda i: F.struct(F.get(g, i).alias("fp"), i.alias("pos"), near(i).alias("near")))

    marks = let(words_of(F.col("text")), lambda words: let(grams(words, k), lambda g: marked(words, g)))
    # the outer form keeps the optimiser from testing, and so computing, the array twice
    marks = docs.select("doc_id", "text_key", F.explode_outer(marks).alias("x")).where("x IS NOT NULL").select("doc_id", "text_key", "x.fp", "x.pos", "x.near").alias("d")
    met = marks.join(found.alias("i"), "fp")
    # window starts in the item's words, up to the fingerprint
    starts = F.sequence(F.lit(0), F.col("lead"))
    left = F.least(F.col("pos"), F.lit(reach))

    def equal(s: Column) -> Column:
        begin = left - (F.col("lead") - s)
        own = F.slice("around", s + 1, length)
        return (begin >= 0) & (F.size(own) == length) & (F.slice("near", F.greatest(begin, F.lit(0)) + 1, length) == own)

    met = met.withColumn("start", F.explode_outer(F.filter(starts, equal))).where("start IS NOT NULL")
    return met.select("doc_id", "text_key", "item", (F.col("pos") - F.col("lead") + F.col("start")).alias("start"), F.lit(length).alias("size"))


def hits_by_document(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, places (start, size), items (ids as strings, sorted) of the documents with a hit."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words"))
    items = materialize(items.distinct()).where("size(words) > 0")
    short = sorted(r.n for r in items.select(F.size("words").alias("n")).where(F.col("n") < WINDOW).distinct().collect())
    own = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")
    hits = hits_of(own, items, K, W, False)
    for m in short:
        hits = hits.unionByName(hits_of(own, items, m, 1, True))
    # grouped by document: at most its words times the items that share them
    return hits.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "size")).alias("places"), F.sort_array(F.collect_set("item")).alias("items"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs."""
    gone = materialize(hits_by_document(docs, benchmark).select("doc_id", "text_key"))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.alias("l").join(gone.alias("r"), of_document(), "left_anti")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, n_words, hit (word positions), items (ids as strings, sorted) for every row."""
    per_doc = hits_by_document(docs, benchmark)
    covered = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["start"], p["start"] + p["size"] - 1))))
    per_doc = per_doc.select("doc_id", "text_key", covered.alias("hit"), "items")
    counted = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), F.size(words_of(F.col("text"))).alias("n_words"))
    joined = counted.alias("l").join(per_doc.alias("r"), same_document(), "left")
    return joined.select("l.doc_id", "l.text_key", F.col("n_words").cast("long").alias("n_words"), F.coalesce("hit", F.array().cast("array<int>")).alias("hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark
), lengths AS (SELECT DISTINCT least(len(words), 10) AS size FROM b WHERE len(words) > 0),
bw AS (
  SELECT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT item_id, words, least(len(words), 10) AS size, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM b WHERE len(words) > 0)
), dw AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d CROSS JOIN lengths WHERE len(words) >= size)
), h AS (SELECT DISTINCT doc_id, i, dw.size, item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.win = bw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
