"""Secret scans: pattern spans, and ownership frequency of candidate values over the corpus.

Candidates are the values of all pattern spans and further key-like tokens (20 or more of
``[A-Za-z0-9_-]``, with at least four digits and four letters and ten different characters,
outside pattern spans).  A value's hash is counted by distinct repository and owner: rows are
distinct (hash, owner, repository) first, then summed by (hash, owner), then by hash, so a
value that a third of all rows hold never meets in one task; nor does it in the join back, where
such values come by a broadcast.  Values of at most ``max_owners`` owners and
``max_repositories`` repositories look live; values of more owners, or in more repositories of
few owners, are copied examples.  Each place of a value that looks live becomes a ``live`` span,
over the value alone, in addition to the pattern spans, which always stay.

By default a repository is a document and an owner is its source.  Only DataFrame expressions
run on executors.

Defined results: null text is empty; a null owner is one owner of its own; repeated rows (equal
id and text) agree and count once; offsets are code points, ends exclusive; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import materialize, read
from palimpsest.llm.spans import NO_SPANS, digest_text, distinct_sorted, find, let, none, outside, same_document, span

#: The patterns of the contract; letters of the names match in either case.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
NAMES = r"(?i:password|passwd|secret|token|api_?key)"
KEY_LIKE = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}"
KINDS = ("assign", "access", "hex", "live")


def base_spans(text: Column) -> dict[str, Column]:
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 2)
    return {
        "assign": F.filter(find(text, ASSIGN, 0, "assign", NAMES), lambda s: F.length(value(s)) >= 12),
        "access": find(text, ACCESS, 1, "access"),
        "hex": find(text, HEX, 2, "hex"),
    }


def key_like(text: Column, base: Column) -> Column:
    """Key-like tokens outside the spans of ``base``."""

    def likely(v: Column) -> Column:
        mixed = (F.length(F.regexp_replace(v, "[^0-9]", "")) >= 4) & (F.length(F.regexp_replace(v, "[^A-Za-z]", "")) >= 4)
        return mixed & (F.size(F.array_distinct(F.split(v, ""))) >= 10)

    return outside(find(text, KEY_LIKE, 3, "live", r"[A-Za-z0-9_-]{20,}", likely), base)


def live_values(each: DataFrame, max_owners: int, max_repositories: int, share: int = 1000) -> DataFrame:
    """The rows of ``each`` (hash, owner, repository, ...) whose value looks live.

    Values in at least one of ``share`` rows, at most ``share`` values therefore, come by a
    broadcast; no other value is hot enough to hold up the shuffled join.
    """
    holders = each.select("hash", "owner", "repository").distinct().groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    spread = materialize(holders.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories")))
    total = spread.agg(F.sum("repositories")).first()[0] or 0
    hot = spread.where(F.col("repositories") * share >= total)
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    rest = each.join(F.broadcast(hot.select("hash")), "hash", "left_anti").join(spread.where(live).select("hash"), "hash", "left_semi")
    return rest.unionByName(each.join(F.broadcast(hot.where(live).select("hash")), "hash", "left_semi"))


def scan(docs: DataFrame, repository: Column | None = None, owner: Column | None = None, max_owners: int = 2, max_repositories: int = 10) -> DataFrame:
    """doc_id, text_key, base and live spans, numbers of live and of copied values for every row of ``docs``."""
    repository = F.col("doc_id") if repository is None else repository
    owner = F.col("source") if owner is None else owner
    rows = docs.select("doc_id", F.coalesce(owner.cast("string"), F.lit("")).alias("owner"), F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "owner", "repository", "text", F.xxhash64("text").alias("text_key"), *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    rows = rows.withColumn("base", F.concat("assign", "access", "hex"))

    def candidate(s: Column) -> Column:
        # the secret itself: of an assignment its right side, which ends it
        value = F.when(s["kind"] == "assign", F.regexp_extract(s["value"], ASSIGN, 2)).otherwise(s["value"])
        return let(value, lambda v: F.struct((s["end"] - F.length(v)).alias("start"), s["end"].alias("end"), F.sha2(v, 256).alias("hash")))

    candidates = distinct_sorted(F.transform(F.concat("base", key_like(F.col("text"), F.col("base"))), candidate))
    found = materialize(rows.select("doc_id", "text_key", "owner", "repository", "base", candidates.alias("candidates")))
    each = found.where(F.size("candidates") > 0).select("doc_id", "text_key", "owner", "repository", F.explode("candidates").alias("s")).select("*", "s.hash")
    live = live_values(each, max_owners, max_repositories).select("doc_id", "text_key", "s.start", "s.end").distinct()
    # each row of a document is one candidate, so groups are as large as one text's spans
    verdicts = live.groupBy("doc_id", "text_key").agg(F.collect_list(span(F.col("start"), F.col("end"), 3, "live", F.lit(""))).alias("added"))
    out = found.alias("l").join(verdicts.alias("r"), same_document(), "left").withColumn("added", F.coalesce("added", none()).cast(NO_SPANS))
    n_live = F.size("added")
    return out.select("l.doc_id", "l.text_key", "base", "added", n_live.cast("long").alias("n_live"), (F.size("candidates") - n_live).cast("long").alias("n_copied"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(digest_text(F.col("base")), 256).alias("base_sha256"), digest_text(F.concat("base", "added")).alias("spans"), "n_live", "n_copied")
