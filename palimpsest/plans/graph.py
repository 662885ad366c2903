"""Link graph: as-of joins, cascaded resolution, missing targets, closure, entity fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators import relations
from palimpsest.operators.asof import nearest_asof
from palimpsest.operators.closure import fixpoint
from palimpsest.plans.registry import CAPTURES, Tables, query

NEAREST = """p AS (SELECT probe_id, arg_max(c.{v}, row(c.timestamp, c.{v})) AS v, max(c.timestamp) AS ts FROM probes r JOIN cands c ON r.url = c.url AND c.timestamp < r.timestamp GROUP BY probe_id),
n AS (SELECT probe_id, arg_min(c.{v}, row(c.timestamp, c.{v})) AS v, min(c.timestamp) AS ts FROM probes r JOIN cands c ON r.url = c.url AND c.timestamp >= r.timestamp GROUP BY probe_id),
s AS (SELECT r.probe_id, r.url, r.timestamp, p.v AS pv, n.v AS nv, p.ts AS pts, n.ts AS nts, epoch(strptime(r.timestamp, '%Y%m%d%H%M%S')) - epoch(strptime(p.ts, '%Y%m%d%H%M%S')) AS dp, epoch(strptime(n.ts, '%Y%m%d%H%M%S')) - epoch(strptime(r.timestamp, '%Y%m%d%H%M%S')) AS dn FROM probes r LEFT JOIN p USING (probe_id) LEFT JOIN n USING (probe_id))
SELECT probe_id, url, timestamp, CASE WHEN pts IS NULL THEN nv WHEN nts IS NULL OR dp <= dn THEN pv ELSE nv END AS {out}, CASE WHEN pts IS NULL THEN nts WHEN nts IS NULL OR dp <= dn THEN pts ELSE nts END AS nearest_timestamp FROM s"""


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.captures().withColumn("url", F.col("user_id") % 20)
    return rows.where("kind = 'click'").select(F.col("capture_id").alias("probe_id"), "url", "timestamp"), rows.where("kind <> 'click'").select("url", "timestamp", "capture_id", F.concat("kind", (F.col("capture_id") % 9).cast("string")).alias("path"))


SIDES = f"{CAPTURES}, probes AS (SELECT capture_id AS probe_id, user_id % 20 AS url, timestamp FROM captures WHERE kind = 'click'), cands AS (SELECT user_id % 20 AS url, timestamp, capture_id, kind || (capture_id % 9) AS path FROM captures WHERE kind <> 'click')"


@query(f"WITH {SIDES}, {NEAREST.format(v='capture_id', out='nearest_capture_id')}")
def nearest_resource(t: Tables) -> DataFrame:
    """The capture nearest in time to each reference; the past wins ties."""
    probes, cands = _sides(t)
    return nearest_asof(probes, cands, ["url"], "timestamp", ["capture_id"], ["capture_id"])


@query(f"WITH {SIDES}, {NEAREST.format(v='path', out='nearest_path')}")
def nearest_alias(t: Tables) -> DataFrame:
    """The route nearest in time to each link; ties by path."""
    probes, cands = _sides(t)
    return nearest_asof(probes, cands, ["url"], "timestamp", ["path"], ["path"])


@query("""WITH r AS (SELECT event_id AS ref_id, user_id AS target FROM events), exact AS (SELECT c_custkey AS target, 'exact/' || c_custkey AS path FROM customer WHERE c_custkey % 3 = 0),
alias AS (SELECT c_custkey AS target, 'alias/' || c_nationkey AS path FROM customer WHERE c_custkey % 3 <> 2), print AS (SELECT c_custkey AS target, 'print/' || c_custkey AS path FROM customer WHERE c_custkey % 7 = 0),
post AS (SELECT c_custkey AS target, 'post/' || c_custkey AS path FROM customer WHERE c_custkey % 5 = 0)
SELECT ref_id, target, coalesce(exact.path, alias.path, print.path, post.path) AS path FROM r LEFT JOIN exact USING (target) LEFT JOIN alias USING (target) LEFT JOIN print USING (target) LEFT JOIN post USING (target)""")
def resolve_cascade(t: Tables) -> DataFrame:
    """First of exact route, alias, print view and post alias (J11); targets are resolved once each."""
    c = t.customer
    routes = lambda where, path: c.where(where).select(F.col("c_custkey").alias("target"), path.alias("path"))
    text = lambda prefix, col: F.concat(F.lit(prefix), F.col(col).cast("string"))
    steps = [routes("c_custkey % 3 = 0", text("exact/", "c_custkey")), routes("c_custkey % 3 <> 2", text("alias/", "c_nationkey")), routes("c_custkey % 7 = 0", text("print/", "c_custkey")), routes("c_custkey % 5 = 0", text("post/", "c_custkey"))]
    best = relations.first_found(steps, ["target"], "path")
    return t.events.select(F.col("event_id").alias("ref_id"), F.col("user_id").alias("target")).join(best, "target", "left").select("ref_id", "target", "path")


@query("""WITH refs AS (SELECT l_orderkey AS page, l_partkey AS target, CASE WHEN l_linenumber % 2 = 0 THEN 'page' ELSE 'asset' END AS kind FROM lineitem), pages AS (SELECT p_partkey AS target FROM part WHERE p_size > 25), assets AS (SELECT p_partkey AS target FROM part WHERE p_size <= 40)
SELECT kind, count(DISTINCT target) AS missing, count(*) AS occurrences FROM refs WHERE (kind = 'page' AND target NOT IN (SELECT target FROM pages) AND target % 10 <> 0) OR (kind = 'asset' AND target NOT IN (SELECT target FROM assets)) GROUP BY kind""")
def missing_refs(t: Tables) -> DataFrame:
    """Targets without a capture, by kind; inert actions aren't missing."""
    refs = t.lineitem.select(F.col("l_partkey").alias("target"), F.when(F.col("l_linenumber") % 2 == 0, "page").otherwise("asset").alias("kind"))
    known = t.part.where("p_size > 25").select(F.lit("page").alias("kind"), F.col("p_partkey").alias("target")).union(t.part.where("p_size <= 40").select(F.lit("asset"), "p_partkey"))
    lost = relations.lost(refs, known, ["kind", "target"], (F.col("kind") == "page") & (F.col("target") % 10 == 0))
    return lost.groupBy("kind").agg(F.count_distinct("target").alias("missing"), F.count("*").alias("occurrences"))


@query("""WITH RECURSIVE edges AS (SELECT DISTINCT p_partkey AS src, (p_partkey * 7 + p_size) % 100 AS dst FROM part), reach AS (SELECT p_partkey AS node FROM part WHERE p_partkey <= 10 UNION SELECT dst FROM reach JOIN edges ON src = node)
SELECT DISTINCT node FROM reach""")
def css_closure(t: Tables) -> DataFrame:
    """Everything that style sheets reach through imports; cycles end."""
    edges = t.part.select(F.col("p_partkey").alias("node"), ((F.col("p_partkey") * 7 + F.col("p_size")) % 100).alias("dst")).distinct()
    seeds = t.part.where("p_partkey <= 10").select(F.col("p_partkey").alias("node"))
    return fixpoint(seeds, lambda f: f.join(edges, "node").select(F.col("dst").alias("node")), ["node"]).select("node")


@query("""WITH missing AS (SELECT DISTINCT l_suppkey AS id, CASE WHEN l_linenumber % 3 = 0 THEN 'forum' WHEN l_linenumber % 3 = 1 THEN 'user' ELSE 'topic' END AS kind FROM lineitem WHERE l_returnflag = 'R'),
known AS (SELECT n_nationkey AS id, 'forum' AS kind FROM nation UNION ALL SELECT c_custkey, 'user' FROM customer UNION ALL SELECT s_suppkey, 'topic' FROM supplier WHERE s_nationkey < 12),
sel AS (SELECT * FROM missing WHERE (id, kind) IN (SELECT id, kind FROM known)), more AS (SELECT s_suppkey AS id, 'topic' AS kind FROM supplier WHERE s_nationkey IN (SELECT id FROM sel WHERE kind = 'forum') UNION SELECT o_orderkey % 50, 'topic' FROM orders WHERE o_custkey IN (SELECT id FROM sel WHERE kind = 'user'))
SELECT id, kind FROM sel UNION SELECT id, kind FROM more""")
def entity_fallback(t: Tables) -> DataFrame:
    """Entities to generate: missing ones that are known, and the topics that theirs need."""
    kind = F.when(F.col("l_linenumber") % 3 == 0, "forum").when(F.col("l_linenumber") % 3 == 1, "user").otherwise("topic")
    asked = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("id"), kind.alias("kind"))
    known = t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.lit("forum").alias("kind")).union(t.customer.select("c_custkey", F.lit("user"))).union(t.supplier.where("s_nationkey < 12").select("s_suppkey", F.lit("topic")))
    shown = lambda df, own, owner, of: df.select(own.alias("id"), F.lit("topic").alias("kind"), F.col(owner).cast("bigint").alias("owner"), F.lit(of).alias("owner_kind"))
    members = [shown(t.supplier, F.col("s_suppkey"), "s_nationkey", "forum"), shown(t.orders, F.col("o_orderkey") % 50, "o_custkey", "user")]
    return relations.with_members(asked, known, ["id", "kind"], [(m, ["owner", "owner_kind"]) for m in members])


@query(f"""WITH {CAPTURES} SELECT capture_id, timestamp, kind = 'purchase' AS is_portal FROM captures WHERE kind IN ('view', 'purchase') ORDER BY (kind = 'purchase') DESC, timestamp DESC, capture_id DESC LIMIT 1""")
def homepage_pick(t: Tables) -> DataFrame:
    """The newest portal, else the newest index page (A13); one row is the feature."""
    rows = t.captures().where(F.col("kind").isin("view", "purchase")).select("capture_id", "timestamp", "kind")
    return relations.newest(rows, F.col("kind") == "purchase", ["timestamp", "capture_id"]).drop("kind")


@query("""WITH k AS (SELECT page_id, url AS key, false AS requested FROM pages UNION ALL SELECT page_id, regexp_replace(url, '[?#].*$', ''), true FROM pages WHERE regexp_replace(url, '[?#].*$', '') <> url) SELECT key, count(*) AS captures, min(page_id) AS first_page FROM k GROUP BY key""")
def requested_alias(t: Tables) -> DataFrame:
    """Captures also answer for the address that was asked for."""
    keys = relations.answering(t.pages.select("page_id", "url"), F.col("url"), F.regexp_replace("url", "[?#].*$", ""), "key")
    return keys.groupBy("key").agg(F.count("*").alias("captures"), F.min("page_id").alias("first_page"))
