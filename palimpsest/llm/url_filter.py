"""URL filters: explicit rules, and a path-template tree with labelled purity.

A path's segments are its shape: all-digit segments (with or without an extension) are the
wildcard ``{n}``, other segments with a digit ``{x}``.  Pages are first summed by host and shape,
so that a host with a third of all pages is as many rows as it has shapes.  From each host down, a node's
branches are compared: one keeps its literal segment only if it has at least ``support`` pages and
its labelled bad rate differs from its siblings' pooled rate (two-sample z-test at ``z``); the
others are alike as far as the labels tell and merge into the wildcard ``*``.  A node's bad rate
is smoothed towards its parent's with weight ``alpha`` (a host's towards the corpus rate).  Only
nodes with at least ``support`` pages and labels of both kinds are parted further; what lies
below any other is one template, ``/**``.  A template whose smoothed rate is at least
``reject`` is blocked, if a label of its own says so: without a labelled page in it, or in its
host, a page is allowed whatever the corpus rate.

The tree is read back to pages by shape; shapes of at least one in ``SHARE`` pages, so at most
``SHARE`` rows, are broadcast, so no hot one meets in a task.

Defined results: a null url, or one without ``://``, has empty host and path; the first ``://``
counts; with no labels at all nothing is blocked; several labels of one page count as bad if one
is; repeated rows agree; rates of exactly ``reject`` block; empty segments count; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import materialize, read

SHARE = 1000
#: Host, path prefix, verdict.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


PARTS = r"(?s)^(?:(?!://).)*+://([^/?#]*+)([^?#]*+)"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, PARTS, 1)
    return F.translate(F.coalesce(found, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def shape_of(path: Column) -> Column:
    """Segments of the path, whole, with variable ones as wildcards."""
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    kind = lambda s: F.when(s.rlike(r"^[0-9]+(\.[A-Za-z]+)?$"), F.lit("{n}")).when(s.rlike("[0-9]"), F.lit("{x}")).otherwise(s)
    return F.transform(parts, kind)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]


def template_verdicts(shapes: DataFrame, support: int, z: float, alpha: float, reject: float) -> DataFrame:
    """(host, shape, n, template, bad_rate, blocked) from (host, shape, n, labelled, bad)."""
    whole = shapes.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).first()
    prior = (whole.bad or 0) / whole.labelled if whole.labelled else 0.0
    #: pages, labelled and bad pages of the node that a shape has come to
    of_node = ["n", "labelled", "bad"]
    smooth = lambda parent: (F.col("bad") + alpha * parent) / (F.col("labelled") + alpha)
    hosts = shapes.groupBy("host").agg(*_sums()).select("host", F.struct(*of_node).alias("node"), smooth(F.lit(prior)).alias("rate"))
    rows = materialize(shapes.join(hosts, "host").withColumn("template", F.lit("")))
    done, depth = [], 0
    while True:
        parted = (F.col("node.n") >= support) & (F.col("node.bad") > 0) & (F.col("node.bad") < F.col("node.labelled")) & (F.size("shape") > depth)
        done.append(rows.where(~parted).withColumn("template", F.when(F.size("shape") > depth, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))))
        rows = rows.where(parted).withColumn("seg", F.get("shape", F.lit(depth)))
        if rows.isEmpty():
            break
        depth += 1
        key = ["host", "template"]
        kids = rows.groupBy(*key, "seg").agg(*_sums())
        every = kids.groupBy(*key).agg(F.sum("labelled").alias("al"), F.sum("bad").alias("ab"))
        # few branches are left when they meet their siblings' sums
        kids = kids.where((F.col("n") >= support) & (F.col("labelled") > 0) & ~F.col("seg").isin("{n}", "{x}")).join(every, key)
        own, rest = F.col("labelled"), F.col("al") - F.col("labelled")
        pooled = F.col("ab") / F.col("al")
        gap = F.col("bad") / own - (F.col("ab") - F.col("bad")) / rest
        error = F.sqrt(pooled * (1 - pooled) * (1 / own + 1 / rest))
        kept = kids.where((rest > 0) & (F.abs(gap) > z * error)).select(*key, "seg", F.lit(True).alias("kept"))
        rows = rows.join(materialize(kept), [*key, "seg"], "left")
        branch = F.when(F.col("kept") | F.col("seg").isin("{n}", "{x}"), F.col("seg")).otherwise(F.lit("*"))
        rows = rows.withColumn("branch", branch).drop("kept", "seg")
        sums = rows.groupBy(*key, "branch").agg(*_sums(), F.max("rate").alias("parent"))
        sums = materialize(sums.select(*key, "branch", F.struct(*of_node).alias("node"), smooth(F.col("parent")).alias("rate")))
        rows = rows.drop("node", "rate").join(sums, [*key, "branch"])
        rows = materialize(rows.withColumn("template", F.concat("template", F.lit("/"), "branch")).drop("branch").select(*done[0].columns))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("host", "shape", "n", "template", F.col("rate").alias("bad_rate"), ((F.col("rate") >= reject) & (F.col("node.labelled") > 0)).alias("blocked"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES, support: int = 20, z: float = 2.58, alpha: float = 10.0, reject: float = 0.5, id_col: str = "page_id") -> DataFrame:
    """id, host, path, rule, verdict, template, bad_rate; ``labels`` has the id as ``_id`` and ``bad`` (boolean)."""
    own = pages.select(F.col(id_col), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    own = own.withColumn("shape", shape_of(F.col("path")))
    marked = labels.where("bad IS NOT NULL").groupBy("_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    seen = own.join(marked, own[id_col] == marked["_id"], "left")
    shapes = materialize(seen.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    verdicts = materialize(template_verdicts(shapes, support, z, alpha, reject))
    total = verdicts.agg(F.sum("n")).first()[0] or 0
    key, hot = ["host", "shape"], F.col("n") * SHARE >= total
    often = verdicts.where(hot).drop("n")
    judged = own.join(F.broadcast(often), key)
    judged = judged.unionByName(own.join(F.broadcast(often.select(*key)), key, "left_anti").join(verdicts.where(~hot).drop("n"), key))
    name, ruled = rule_for(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(id_col, "host", "path", name.alias("rule"), F.coalesce(ruled, learned).alias("verdict"), "template", "bad_rate")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document whose number ends its path: low quality or toxic is bad."""
    pages, labels = read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    of_page = pages.select(F.col("page_id").alias("_id"), number.try_cast("bigint").alias("doc_id"))
    marked = of_page.join(labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")), "doc_id")
    return filter_urls(pages, marked)
