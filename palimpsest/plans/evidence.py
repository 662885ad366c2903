"""Manifest validity, provenance bridges, period filters and integrity gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.identity import payload_digest, post_identity
from palimpsest.operators import gates, relations
from palimpsest.plans.registry import CAPTURES, POSTS, Tables, query
from palimpsest.sources import harvest
from palimpsest.sources.manifest import ROW_RULES


def _manifest(t: Tables) -> DataFrame:
    """``events`` as manifest rows, some of them broken on purpose."""
    sha = F.sha2(F.col("event_id").cast("string").cast("binary"), 256)
    digest = payload_digest(F.col("event_id").cast("string").cast("binary"))
    e = F.col("event_id")
    source = F.when(e % 3 == 0, "wayback").when(e % 3 == 1, "commoncrawl").otherwise("wayback-availability")
    return t.events.select(
        "event_id",
        F.when(e % 11 == 0, "2005").otherwise(F.date_format("ts", "yyyyMMddHHmmss")).alias("timestamp"),
        F.concat(F.when(e % 13 == 0, "ftp").otherwise("http"), F.lit("://example.net/"), e.cast("string")).alias("original_url"),
        F.lit("200").alias("statuscode"), F.when(e % 17 != 0, "text/html").alias("mimetype"), digest.alias("digest"), F.when(e % 19 == 0, F.lower(digest)).otherwise(digest).alias("payload_digest"),
        F.when(source != "wayback-availability", F.lit(True)).alias("cdx_digest_matches_payload"), F.lit("10").alias("length"), F.when(e % 23 == 0, "x").otherwise("10").alias("retrieved_length"),
        sha.alias("sha256"), F.concat(F.lit("blobs/"), F.when(e % 29 == 0, "../").otherwise(F.concat(F.substring(sha, 1, 2), F.lit("/"))), sha).alias("path"), F.when(e % 31 == 0, "disk").otherwise(source).alias("source"),
        F.when(source == "wayback-availability", F.lit("http://example.net/")).alias("requested_url"), F.when(source == "wayback-availability", "computed-payload").alias("digest_source"), F.when(source == "commoncrawl", e % 37 != 1).alias("source_record_complete"),
    )


@query("""WITH e AS (SELECT event_id AS e, CASE WHEN event_id % 31 = 0 THEN 'disk' WHEN event_id % 3 = 0 THEN 'wayback' WHEN event_id % 3 = 1 THEN 'commoncrawl' ELSE 'wayback-availability' END AS source FROM events),
v AS (SELECT e, (e % 11 <> 0 AND e % 13 <> 0 AND e % 17 <> 0 AND e % 19 <> 0 AND e % 23 <> 0 AND e % 29 <> 0 AND e % 31 <> 0 AND NOT (source = 'commoncrawl' AND e % 37 = 1)) AS valid, source FROM e)
SELECT source, count(*) AS n, count(*) FILTER (WHERE valid) AS valid FROM v GROUP BY source""")
def manifest_valid(t: Tables) -> DataFrame:
    """Rows that satisfy all manifest rules, by source (F1)."""
    rows = _manifest(t)
    valid = F.lit(True)
    for rule in ROW_RULES.values():
        valid &= F.coalesce(rule, F.lit(False))
    return rows.withColumn("ok", valid).groupBy("source").agg(F.count("*").alias("n"), F.count_if("ok").alias("valid"))


@query("""WITH e AS (SELECT event_id AS e, event_id % 3 AS k FROM events), v AS (
SELECT 'timestamp' AS rule FROM e WHERE e % 11 = 0 UNION ALL SELECT 'original_url' FROM e WHERE e % 13 = 0 UNION ALL SELECT 'mimetype' FROM e WHERE e % 17 = 0 UNION ALL SELECT 'payload_digest' FROM e WHERE e % 19 = 0
UNION ALL SELECT 'retrieved_length' FROM e WHERE e % 23 = 0 UNION ALL SELECT 'path' FROM e WHERE e % 29 = 0 UNION ALL SELECT 'source' FROM e WHERE e % 31 = 0)
SELECT rule, count(*) AS n FROM v GROUP BY rule""")
def manifest_violations(t: Tables) -> DataFrame:
    """How many rows break each of the single-column rules (G1)."""
    names = ("timestamp", "original_url", "mimetype", "payload_digest", "retrieved_length", "path", "source")
    broken = gates.violations(_manifest(t), {n: ROW_RULES[n] for n in names})
    return broken.select(F.explode("broken").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


DIGITS = ", ".join(f"('0x' || substr(s, {5 * i + 1}, 5))::INT" for i in range(8))
LETTERS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((d[{i + 1}] >> {s}) & 31) + 1)::INT, 1)" for i in range(8) for s in (15, 10, 5, 0))


@query(f"WITH h AS (SELECT doc_id, sha1(text) AS s, sha256(text) AS sha256, strlen(text) AS byte_length FROM documents), n AS (SELECT *, [{DIGITS}] AS d FROM h) SELECT doc_id, {LETTERS} AS payload_digest, sha256, byte_length FROM n")
def payload_digests(t: Tables) -> DataFrame:
    """Digests and length of every payload."""
    raw = F.col("text").cast("binary")
    return t.documents.select("doc_id", payload_digest(raw).alias("payload_digest"), F.sha2(raw, 256).alias("sha256"), F.octet_length(raw).cast("bigint").alias("byte_length"))


@query("SELECT doc_id % 4 AS mime, count(*) AS n, count(*) FILTER (WHERE doc_id % 4 = 1) AS parsed, count(*) FILTER (WHERE doc_id % 4 = 0) AS stylesheets, count(*) FILTER (WHERE doc_id % 4 > 1) AS stored FROM documents GROUP BY 1")
def mime_routing(t: Tables) -> DataFrame:
    """Payloads by type: style sheets, pages, others."""
    mime = F.element_at(F.array(*map(F.lit, ("text/css", "text/html", "image/gif", "application/pdf"))), (F.col("doc_id") % 4 + 1).cast("int"))
    rows = t.documents.select((F.col("doc_id") % 4).alias("mime"), relations.role(mime).alias("role"))
    n = lambda role, name: F.count_if(F.col("role") == role).alias(name)
    return rows.groupBy("mime").agg(F.count("*").alias("n"), n("page", "parsed"), n("stylesheet", "stylesheets"), n("stored", "stored"))


@query(f"""WITH {POSTS} SELECT post_id, posted_at FROM posts WHERE posted_at BETWEEN '1994-01-01T00:00:00' AND '1995-06-30T23:59:59'
UNION ALL SELECT -o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') FROM orders WHERE coalesce(CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END BETWEEN '1994-01-01T00:00:00' AND '1995-06-30T23:59:59', false) OR coalesce(CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END BETWEEN '1994-01-01T00:00:00' AND '1995-06-30T23:59:59', false)""")
def period_filter(t: Tables) -> DataFrame:
    """Posts in the period and listings with either time in it."""
    inside = lambda c: relations.within(c, "1994-01-01T00:00:00", "1995-06-30T23:59:59")
    posts = t.posts().where(inside(F.col("posted_at"))).select("post_id", "posted_at")
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    listings = t.orders.where(inside(F.when(F.col("o_orderstatus") == "O", at)) | inside(F.when(F.col("o_orderstatus") == "P", at)))
    return posts.unionByName(listings.select((-F.col("o_orderkey")).alias("post_id"), at.alias("posted_at")))


@query("""SELECT sha256(CASE WHEN doc_id % 2 = 0 THEN 'historical:' || lang || ':' || doc_id ELSE 'content' || chr(31) || lang || chr(31) || CASE WHEN doc_id % 7 = 0 THEN '' ELSE (doc_id % 7)::VARCHAR END || chr(31) || source || chr(31) || '' || chr(31) || text END) AS identity, count(*) AS sources, min(doc_id) AS first_capture_id
FROM documents GROUP BY 1""")
def content_identity_dedup(t: Tables) -> DataFrame:
    """Posts by identity: by id where they have one, else by content."""
    topic, none = (F.col("doc_id") % 7), F.lit(None).cast("string")
    identity = post_identity(F.col("lang"), F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")), topic, F.col("source"), none, none, F.col("text"))
    return t.documents.select(identity.alias("identity"), "doc_id").groupBy("identity").agg(F.count("*").alias("sources"), F.min("doc_id").alias("first_capture_id"))


@query("SELECT l_orderkey AS post_id, count(DISTINCT l_suppkey) AS sources, min(l_suppkey) AS first_source FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' GROUP BY 1")
def post_sources(t: Tables) -> DataFrame:
    """Distinct provenance of posts through the pending bridge."""
    pending = t.lineitem.select(F.col("l_orderkey").alias("post_id"), F.col("l_suppkey").alias("capture_id"))
    posts = t.orders.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("post_id"))
    found = relations.provenance(posts, pending, "post_id")
    return found.groupBy("post_id").agg(F.count("*").alias("sources"), F.min("capture_id").alias("first_source"))


@query("""SELECT o_orderkey AS post_id, l_suppkey AS capture_id, s_nationkey AS topic_id FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
WHERE o_orderstatus = 'O' AND l_returnflag = 'N' AND l_linestatus = 'O' AND s_nationkey = 3 AND o_orderpriority = '1-URGENT'""")
def terminal_evidence(t: Tables) -> DataFrame:
    """Posts whose captures prove the end of the period."""
    posts = t.orders.where("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("post_id"))
    bridge = t.lineitem.where("l_returnflag = 'N' AND l_linestatus = 'O'").select(F.col("l_orderkey").alias("post_id"), F.col("l_suppkey").alias("capture_id"))
    captures = t.supplier.where("s_nationkey = 3").select(F.col("s_suppkey").alias("capture_id"), F.col("s_nationkey").alias("topic_id"))
    return relations.proofs(posts, bridge, captures, "post_id", "capture_id").select("post_id", "capture_id", "topic_id")


@query(f"""WITH {CAPTURES} SELECT capture_id, kind, timestamp FROM captures WHERE value >= 5 AND kind IN ('view', 'click', 'purchase') ORDER BY CASE kind WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, timestamp, capture_id LIMIT 50""")
def pending_topk(t: Tables) -> DataFrame:
    """The head of the download queue (F13, O8); the limit is the feature."""
    rows = t.captures().where((F.col("value") >= 5) & F.col("kind").isin("view", "click", "purchase"))
    rank = F.when(F.col("kind") == "view", 0).when(F.col("kind") == "click", 1).otherwise(2)
    return relations.queue_head(rows, rank, ["timestamp", "capture_id"], 50).select("capture_id", "kind", "timestamp")


@query("SELECT event_id, user_id FROM events WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = user_id AND o_orderkey % 3 = 0)")
def resume_antijoin(t: Tables) -> DataFrame:
    """Inventory entries that aren't in the manifest yet."""
    done = t.orders.where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("user_id"))
    return harvest.pending(t.events.select("event_id", "user_id"), done, ("user_id",))


@query(f"""WITH {CAPTURES}, r AS (SELECT capture_id, timestamp, user_id % 30 AS url, kind, value >= 10 AS valid FROM captures),
k AS (SELECT timestamp, url, max(capture_id) AS line, min(capture_id) AS position FROM r WHERE valid GROUP BY ALL)
SELECT timestamp, url, position, (SELECT kind FROM r WHERE capture_id = line) AS kind FROM k""")
def manifest_compact(t: Tables) -> DataFrame:
    """The last valid row of each key at the place of its first."""
    rows = t.captures().where("value >= 10").select("timestamp", (F.col("user_id") % 30).alias("url"), "kind", F.col("capture_id").alias("position"))
    return relations.last_valid(rows, ["timestamp", "url"], "position")


@query("""SELECT 'orders_customer' AS gate, count(*) AS broken FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'lineitem_part', count(*) FROM lineitem WHERE l_partkey % 7 <> 0 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 7 <> 1)
UNION ALL SELECT 'pages_url', count(*) FROM (SELECT url FROM pages GROUP BY url HAVING count(*) > 1) UNION ALL SELECT 'labels_check', count(*) FROM labels WHERE quality NOT IN (0, 1) OR toxic NOT IN (0, 1)""")
def schema_gates(t: Tables) -> DataFrame:
    """Foreign keys, unique keys and checks as counts of offenders."""
    count = lambda df, name: df.agg(F.lit(name).alias("gate"), F.count("*").alias("broken"))
    orders = gates.unmatched(t.orders.select(F.col("o_custkey").alias("k")), t.customer.select(F.col("c_custkey").alias("k")), ["k"])
    parts = gates.unmatched(t.lineitem.where("l_partkey % 7 <> 0").select(F.col("l_partkey").alias("k")), t.part.where("p_partkey % 7 <> 1").select(F.col("p_partkey").alias("k")), ["k"])
    urls = gates.repeated(t.pages, ["url"])
    checks = gates.violations(t.labels, {"quality": F.col("quality").isin(0, 1), "toxic": F.col("toxic").isin(0, 1)})
    return count(orders, "orders_customer").union(count(parts, "lineitem_part")).union(count(urls, "pages_url")).union(count(checks, "labels_check"))


