"""PII: pattern spans, and information-theoretic sanitisation of the terms that reveal them.

A protected entity is the value of a pattern span.  Over the corpus of distinct texts, with N
texts, n(e) with entity e, n(t) with term t and n(e, t) with both anywhere, a term discloses PMI(t; e) = log2(N P(e|t) / n(e)) bits of the entity's IC(e) = log2(N / n(e)).
P(e|t) is the lower bound of Wilson's interval for n(e, t) of n(t) texts at ``z`` (one-sided 95 %),
so every pair is rated, also of entities in one text, and few texts count as weak evidence.  In
texts with e, a term that discloses at least ``beta`` of IC(e) is generalised; one that discloses
at least ``remove`` of it is removed.  Each of its occurrences outside the pattern spans becomes a
span beside those, which always stay.

Counts are distinct (entity, term) rows of each distinct text, summed with map-side combining, so
an entity in a third of all texts is spread over its terms; the joins back to texts leave a hot
key to the adaptive split of skewed joins.  Only texts with entities are joined or shuffled.
Terms and entities are known by 64-bit hashes.  Only DataFrame expressions run on executors.

Defined results: null text is empty; repeated rows agree, and equal texts count once in the
statistics; offsets are code points, ends exclusive; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import materialize, read
from palimpsest.llm.spans import NO_SPANS, digest_text, find, let, none, outside, replace_spans

#: The patterns of the contract, with possessive loops where these can't change a match.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TERM = r"\p{L}{3,}+"
#: Keys of repeated texts beyond this many are joined by shuffling.
BROADCAST_ROWS = 100_000


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """From the right, every second digit counts twice, as the sum of its product's digits."""
    each = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + (d.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    small = lambda part: (F.length(F.regexp_replace(part, "^0+", "")) <= 3) & (F.substring(F.regexp_replace(part, "^0+(?=.)", ""), 1, 3).cast("int") <= 255)
    count = lambda s: F.length(_digits(s["value"]))
    return {
        "email": find(text, EMAIL, 0, "email", r"@[A-Za-z0-9-]+\.[A-Za-z0-9-]"),
        "ip": F.filter(find(text, IP, 1, "ip", r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), lambda s: F.forall(F.split(s["value"], r"\."), small)),
        "card": F.filter(find(text, CARD, 2, "card"), lambda s: count(s).between(12, 19) & _luhn(s["value"])),
        "phone": F.filter(find(text, PHONE, 3, "phone", r"\+[0-9]"), lambda s: count(s).between(9, 15)),
    }


def _lower(text: Column) -> Column:
    """Lower case, letter by letter: the letters whose lower case depends on others, or is two, are replaced first."""
    return F.lower(F.when(text.rlike("[\u0130\u03a3\u03c2]"), F.translate(text, "\u0130\u03a3\u03c2", "i\u03c3\u03c3")).otherwise(text))


def terms_of(text: Column) -> Column:
    """Distinct terms of a whole text, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(_lower(text), F.lit(TERM), F.lit(0)))


def detect(docs: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Narrow rows: doc_id, text_key, base spans, hashes of the entities; written to the shared folder.

    Where there are entities, they also have the text, and the named columns of the document in ``row``.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys(("doc_id", "text", *columns))])
    rows = docs.select(carried.alias("row")).withColumn("whole", F.coalesce("row.text", F.lit("")))
    rows = rows.withColumn("base", F.concat(*base_spans(F.col("whole")).values()))
    entities = F.array_distinct(F.transform("base", lambda s: F.xxhash64(F.concat_ws(":", s["kind"], s["value"]))))
    if_any = lambda name: F.when(F.size("base") > 0, F.col(name))
    return materialize(rows.select("row.doc_id", F.xxhash64("whole").alias("text_key"), "base", entities.alias("entities"), if_any("whole").alias("text"), if_any("row").alias("row")))


def term_frequency(docs: DataFrame, found: DataFrame) -> DataFrame:
    """term (hash), n_t: the number of distinct texts with each term of the corpus.

    Words are summed before any join, so rows grow with the vocabulary.  Of c equal texts each
    counts 1 / c; those are joined to their documents by a broadcast up to ``BROADCAST_ROWS``.
    """
    copies = materialize(found.groupBy("text_key").agg(F.count("*").alias("copies")).where("copies > 1"))
    if copies.count() <= BROADCAST_ROWS:
        copies = F.broadcast(copies)
    own = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("text_key"), "text").join(copies, "text_key", "left")
    words = own.select(F.coalesce("copies", F.lit(1)).alias("copies"), F.explode_outer(terms_of(F.col("text"))).alias("term"))
    return words.where("term IS NOT NULL").groupBy(F.xxhash64("term").alias("term")).agg(F.round(F.sum(1 / F.col("copies"))).cast("bigint").alias("n_t"))


def lower_bound(hits: Column, n: Column, z: float) -> Column:
    """Lower end of Wilson's interval for the share ``hits`` of ``n``; above 0 for any hit."""
    p = hits / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def disclosing_terms(docs: DataFrame, found: DataFrame, z: float = 1.645, beta: float = 0.8, remove: float = 0.98) -> DataFrame:
    """text_key, told, gone: hashes of a text's terms whose disclosure reaches ``beta``, and of those that reach ``remove``; written.

    An entity of one text has its terms there as pairs, each once, so those pairs are rated by
    the terms' frequencies alone, without being counted.
    """
    held = materialize(found.where(F.size("entities") > 0).select("text_key", "entities", "text").dropDuplicates(["text_key"]))
    if held.isEmpty():
        return docs.sparkSession.createDataFrame([], "text_key long, told array<long>, gone array<long>")
    texts = float(found.select("text_key").distinct().count())
    frequency = materialize(term_frequency(docs, found))

    def share(hits: Column, n_t: Column, n_e: Column) -> Column:
        disclosed = F.log2(F.lit(texts) * lower_bound(hits.cast("double"), n_t.cast("double"), z) / n_e)
        return disclosed / F.greatest(F.log2(F.lit(texts) / n_e), F.lit(1e-9))

    each = held.select("text_key", F.explode("entities").alias("entity"))
    n_e = each.groupBy("entity").agg(F.count("*").alias("n_e"))
    each = materialize(each.join(n_e, "entity"))
    terms = F.explode(F.transform(terms_of(F.col("text")), lambda t: F.xxhash64(t))).alias("term")

    alone = each.where("n_e = 1").select("text_key").distinct()
    rare = frequency.select("term", share(F.lit(1), F.col("n_t"), F.lit(1)).alias("share")).where(F.col("share") >= beta)
    told = held.join(alone, "text_key", "left_semi").select("text_key", terms).join(rare, "term").select("text_key", "term", "share")

    seen = held.join(each.where("n_e > 1"), "text_key").select("text_key", "entity", "n_e", terms)
    pairs = seen.groupBy("entity", "term").agg(F.count("*").alias("n_et"), F.max("n_e").alias("n_e")).join(frequency, "term")
    rated = pairs.select("entity", "term", share(F.col("n_et"), F.col("n_t"), F.col("n_e")).alias("share")).where(F.col("share") >= beta)
    told = told.unionByName(seen.join(rated, ["entity", "term"]).select("text_key", "term", "share"))
    # grouped by text: at most its own terms
    return materialize(told.groupBy("text_key").agg(F.collect_set("term").alias("told"), F.collect_set(F.when(F.col("share") >= remove, F.col("term"))).alias("gone")))


def _among(values: Column, test) -> Column:
    """``test`` of a function that tells whether a hash is in ``values``, which are parted so that each look reads about a root of them."""
    parts = F.ceil(F.sqrt(F.size(values) + 1)).cast("int")
    parted = F.transform(F.sequence(F.lit(0), parts - 1), lambda b: F.filter(values, lambda v: F.pmod(v, parts) == b))
    return let(parted, lambda p: test(lambda h: F.array_contains(F.get(p, F.pmod(h, F.size(p)).cast("int")), h)))


def added_spans(text: Column, base: Column, told: Column, gone: Column) -> Column:
    """Every occurrence of the terms ``told`` and ``gone`` (hashes) in ``text`` outside the spans of ``base``."""

    def marked(is_told, is_gone) -> Column:
        # letters keep their places when lower-cased
        found = let(_lower(text), lambda low: find(low, TERM, 4, "generalise", wanted=lambda t: is_told(F.xxhash64(t))))

        def named(t: Column) -> Column:
            rid = is_gone(F.xxhash64(t["value"]))
            return F.struct(t["start"], t["end"], F.when(rid, 5).otherwise(4).alias("rank"), F.when(rid, "remove").otherwise("generalise").alias("kind"), t["value"])

        return F.transform(outside(found, base), named).cast(NO_SPANS)

    spans = _among(told, lambda is_told: _among(gone, lambda is_gone: marked(is_told, is_gone)))
    return F.when(told.isNull() | (F.size(told) == 0), none()).otherwise(spans)


def with_added(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``found`` that have entities, with ``added``; only their texts, not the corpus, are joined."""
    own = found.where(F.size("entities") > 0).join(disclosing_terms(docs, found), "text_key", "left")
    return own.select("doc_id", "text_key", "base", added_spans(F.col("text"), F.col("base"), F.col("told"), F.col("gone")).alias("added"), "text", "row")


def find_all(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base, added for every row of ``docs``."""
    found = detect(docs)
    rest = found.where(F.size("entities") == 0).select("doc_id", "text_key", "base", none().alias("added"))
    return rest.unionByName(with_added(docs, found).drop("text", "row"))


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns kept, with the text sanitised.

    Pattern spans become ``[KIND]``, generalised terms ``[TERM]``, removed terms nothing.  Rows
    without an entity pass as they are.
    """
    found = detect(docs, tuple(docs.columns))
    label = lambda s: F.when(s["kind"] == "remove", F.lit("")).when(s["kind"] == "generalise", F.lit("[TERM]")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    own = with_added(docs, found)
    clean = replace_spans(F.col("text"), F.concat("base", "added"), label)
    own = own.select(*[clean.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
    rest = docs.where(F.size(F.concat(*base_spans(F.coalesce("text", F.lit(""))).values())) == 0)
    return rest.unionByName(own)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_all(read(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("email"), n("ip"), n("card"), n("phone"), F.sha2(digest_text(F.col("base")), 256).alias("base_sha256"), digest_text(F.concat("base", "added")).alias("spans"))
