"""Capture merges, argmaxes and activity statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators import relations
from palimpsest.operators.merge import argmax_row, conflict_checked, dominant, latest_wins
from palimpsest.plans.registry import CAPTURES, POSTS, Tables, query
from palimpsest.sources import harvest


@query(f"""WITH {CAPTURES}, v AS (SELECT *, nullif(kind, 'error') AS title FROM captures),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, timestamp ORDER BY capture_id) AS rn FROM v) WHERE rn = 1)
SELECT w.user_id, max(timestamp) AS timestamp, arg_max(value, timestamp) AS value, arg_max(capture_id, timestamp) AS best_capture_id,
 arg_max(title, timestamp) FILTER (WHERE title IS NOT NULL) AS title, (SELECT min(capture_id) FROM v WHERE v.user_id = w.user_id) AS first_capture_id FROM w GROUP BY w.user_id""")
def latest_capture_wins(t: Tables) -> DataFrame:
    """Posts (U7): strictly newer captures replace; titles are coalesced, the first capture stays."""
    rows = t.captures().withColumn("title", F.nullif("kind", F.lit("error"))).withColumn("best_capture_id", F.col("capture_id"))
    return latest_wins(rows, ["user_id"], "timestamp", ["capture_id"], ["value", "best_capture_id"], ["title"], {"first_capture_id": "capture_id"})


@query(f"""WITH {CAPTURES}, v AS (SELECT *, kind || ':' || (user_id % 50) AS identity, nullif(kind, 'view') AS forum_name FROM captures),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY identity, timestamp ORDER BY capture_id) AS rn FROM v) WHERE rn = 1)
SELECT identity, max(timestamp) AS timestamp, arg_max(value, timestamp) AS value, arg_max(forum_name, timestamp) FILTER (WHERE forum_name IS NOT NULL) AS forum_name,
 (SELECT arg_min(v.user_id, v.capture_id) FROM v WHERE v.identity = w.identity) AS user_id FROM w GROUP BY identity""")
def evidence_merge(t: Tables) -> DataFrame:
    """Activity evidence (U8): owner fields are never updated, so they come from the first row."""
    rows = t.captures().withColumn("identity", F.concat_ws(":", "kind", (F.col("user_id") % 50).cast("string"))).withColumn("forum_name", F.nullif("kind", F.lit("view")))
    return latest_wins(rows, ["identity"], "timestamp", ["capture_id"], ["value"], ["forum_name"], {"user_id": "user_id"})


@query(f"""WITH {CAPTURES}, v AS (SELECT user_id % 40 AS forum_id, timestamp, capture_id, nullif(kind, 'error') AS name FROM captures)
SELECT forum_id, arg_max(name, capture_id) FILTER (WHERE name IS NOT NULL) AS name, min(timestamp) AS first_seen, max(timestamp) AS last_seen FROM v GROUP BY forum_id""")
def forum_merge(t: Tables) -> DataFrame:
    """Forums (U4): last known name in ingestion order, extremes of the times seen."""
    rows = t.captures().select((F.col("user_id") % 40).alias("forum_id"), "timestamp", "capture_id", F.nullif("kind", F.lit("error")).alias("name"))
    return relations.merge_known(rows, ["forum_id"], ["capture_id"], {"name": "name"}, more=relations.seen())


@query(f"""WITH {CAPTURES}, v AS (SELECT user_id AS topic_id, user_id % 7 AS forum_id, timestamp, capture_id, nullif(kind, 'click') AS title, CASE WHEN value > 50 THEN timestamp END AS listed FROM captures)
SELECT topic_id, arg_max(title, capture_id) FILTER (WHERE title IS NOT NULL) AS title, arg_min(listed, capture_id) FILTER (WHERE listed IS NOT NULL) AS first_posted_at,
 arg_max(listed, capture_id) FILTER (WHERE listed IS NOT NULL) AS last_posted_at, min(timestamp) AS first_seen, max(timestamp) AS last_seen FROM v GROUP BY topic_id""")
def topic_merge(t: Tables) -> DataFrame:
    """Topics (U5): last known title, first and last known listing times."""
    rows = t.captures().select(F.col("user_id").alias("topic_id"), "timestamp", "capture_id", F.nullif("kind", F.lit("click")).alias("title"), F.when(F.col("value") > 50, F.col("timestamp")).alias("listed"))
    return relations.merge_known(rows, ["topic_id"], ["capture_id"], {"title": "title", "last_posted_at": "listed"}, {"first_posted_at": "listed"}, relations.seen())


@query(f"""WITH {CAPTURES}, v AS (SELECT CASE WHEN user_id % 3 = 0 THEN 'name:a:' || kind ELSE 'id:a:' || user_id END AS identity, CASE WHEN user_id % 3 <> 0 THEN user_id END AS historical_id, kind || (capture_id % 5) AS username, capture_id FROM captures)
SELECT identity, coalesce(min(historical_id), 0) AS historical_id, CASE WHEN identity LIKE 'id:%' THEN arg_max(username, capture_id) ELSE arg_min(username, capture_id) END AS username FROM v GROUP BY identity""")
def user_merge(t: Tables) -> DataFrame:
    """Users (U6): the last name of users with an id, the first of users known by name."""
    named = F.col("user_id") % 3 == 0
    rows = t.captures().select(F.when(named, F.concat(F.lit("name:a:"), "kind")).otherwise(F.concat(F.lit("id:a:"), F.col("user_id").cast("string"))).alias("identity"), F.when(~named, F.col("user_id")).alias("historical_id"), F.concat("kind", (F.col("capture_id") % 5).cast("string")).alias("username"), "capture_id")
    got = relations.merge_users(rows, "identity", ["capture_id"], ["username"], F.col("identity").startswith("id:"), ["historical_id"])
    return got.select("identity", F.coalesce("historical_id", F.lit(0)).alias("historical_id"), "username")


@query(f"""WITH {CAPTURES}, v AS (SELECT user_id AS url, timestamp, capture_id, nullif(kind, 'view') AS mimetype, CASE WHEN value > 10 THEN value END AS length FROM captures)
SELECT url, timestamp, arg_max(mimetype, capture_id) FILTER (WHERE mimetype IS NOT NULL) AS mimetype, arg_max(length, capture_id) FILTER (WHERE length IS NOT NULL) AS length,
 arg_min(mimetype, capture_id) FILTER (WHERE mimetype IS NOT NULL) AS blob_mimetype FROM v GROUP BY url, timestamp""")
def capture_blob_merge(t: Tables) -> DataFrame:
    """Captures (U1) keep the last known values, blobs (U2) the first known type."""
    rows = t.captures().select(F.col("user_id").alias("url"), "timestamp", "capture_id", F.nullif("kind", F.lit("view")).alias("mimetype"), F.when(F.col("value") > 10, F.col("value")).alias("length"))
    return relations.merge_known(rows, ["url", "timestamp"], ["capture_id"], {"mimetype": "mimetype", "length": "length"}, {"blob_mimetype": "mimetype"})


@query(f"""WITH {CAPTURES}, c AS (SELECT user_id, hash_v, count(*) AS occurrences FROM (SELECT user_id, capture_id % 5 AS hash_v FROM captures) GROUP BY ALL)
SELECT user_id, hash_v AS topic_id, occurrences FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY occurrences DESC, hash_v) AS rn FROM c) WHERE rn = 1""")
def dominant_topic(t: Tables) -> DataFrame:
    """The most frequent topic of a capture (A2, A6), the least of equally frequent ones."""
    return dominant(t.captures().select("user_id", (F.col("capture_id") % 5).alias("topic_id")), ["user_id"], "topic_id")


@query(f"""WITH {CAPTURES}, r AS (SELECT user_id % 100 AS route, timestamp, kind AS original_url, capture_id AS sha FROM captures)
SELECT route, timestamp, original_url, sha, duplicates FROM (SELECT *, row_number() OVER (PARTITION BY route ORDER BY timestamp DESC, original_url DESC, sha DESC) AS rn, count(*) OVER (PARTITION BY route) - 1 AS duplicates FROM r) WHERE rn = 1""")
def route_argmax(t: Tables) -> DataFrame:
    """The newest capture of each route (A10)."""
    rows = t.captures().select((F.col("user_id") % 100).alias("route"), "timestamp", F.col("kind").alias("original_url"), F.col("capture_id").alias("sha"))
    return argmax_row(rows, ["route"], ["timestamp", "original_url", "sha"])


@query(f"""WITH {CAPTURES} SELECT user_id % 100 AS route, timestamp, count(DISTINCT kind) AS versions FROM captures WHERE user_id % 10 <> 0 GROUP BY ALL HAVING count(DISTINCT kind) > 1""")
def route_collisions(t: Tables) -> DataFrame:
    """Routes with different contents at one time, but for intentionally shared ones."""
    rows = t.captures().select((F.col("user_id") % 100).alias("route"), "timestamp", "kind")
    return relations.collisions(rows, ["route", "timestamp"], "kind", F.col("route") % 10 == 0)


@query(f"""WITH {CAPTURES}, k AS (SELECT timestamp, user_id % 25 AS original_url, capture_id, kind FROM captures)
SELECT timestamp, original_url, min(capture_id) AS capture_id, arg_min(kind, capture_id) AS kind, count(DISTINCT kind) AS versions FROM k GROUP BY timestamp, original_url""")
def cdx_dedup(t: Tables) -> DataFrame:
    """First record of each (time, address) and the number of its versions (S3, K4)."""
    rows = t.captures().select("timestamp", (F.col("user_id") % 25).alias("original_url"), "capture_id", "kind")
    return conflict_checked(rows, ["timestamp", "original_url"], ["capture_id"])


ACTIVITY = "activity AS (SELECT era, topic_id, user_id, posted_at FROM posts WHERE status <> 'F' UNION ALL SELECT era, topic_id, user_id, posted_at FROM posts WHERE status = 'F' AND post_id % 2 = 0)"


def activity(t: Tables) -> DataFrame:
    """Posts and evidence together (set operation of §2.9)."""
    posts = t.posts().select("era", "topic_id", "user_id", "posted_at", "status", "post_id")
    return relations.activity(posts.where("status <> 'F'").drop("status", "post_id"), posts.where("status = 'F' AND post_id % 2 = 0").drop("status", "post_id"))


@query(f"""WITH {POSTS}, {ACTIVITY}, s AS (SELECT era, topic_id, min(posted_at) AS lo, max(posted_at) AS hi FROM activity WHERE posted_at IS NOT NULL GROUP BY ALL),
topics AS (SELECT DISTINCT c_mktsegment AS era, c_nationkey AS topic_id, '1900' AS listed FROM customer)
SELECT era, topic_id, coalesce(lo, listed) AS first_posted_at, coalesce(hi, listed) AS last_posted_at FROM topics LEFT JOIN s USING (era, topic_id)""")
def topic_activity(t: Tables) -> DataFrame:
    """Extremes of the activity of each topic; topics without any keep their listing's (A3)."""
    topics = t.customer.select(F.col("c_mktsegment").alias("era"), F.col("c_nationkey").alias("topic_id")).distinct()
    return relations.with_activity(topics, activity(t), ["era", "topic_id"], F.lit("1900"), F.lit("1900"))


@query(f"""WITH {POSTS}, {ACTIVITY}, s AS (SELECT user_id, min(posted_at) AS lo, max(posted_at) AS hi FROM activity GROUP BY ALL), n AS (SELECT user_id, count(*) AS n FROM posts GROUP BY ALL)
SELECT c_custkey AS user_id, lo AS first_posted_at, hi AS last_posted_at, coalesce(n, 0) AS post_count FROM customer LEFT JOIN s ON s.user_id = c_custkey LEFT JOIN n ON n.user_id = c_custkey""")
def user_activity(t: Tables) -> DataFrame:
    """Extremes of the activity and number of posts of each user, also of those without any (A4)."""
    users = t.customer.select(F.col("c_custkey").alias("user_id"))
    return relations.with_count(relations.with_activity(users, activity(t), ["user_id"]), t.posts(), "user_id", "post_count")


@query("SELECT (SELECT count(*) FROM events) AS captures, (SELECT count(*) FROM orders) AS posts, (SELECT count(*) FROM customer) AS users, (SELECT count(*) FROM nation) AS forums, (SELECT count(*) FROM pages) AS pages, (SELECT count(*) FROM documents) AS documents")
def table_counts(t: Tables) -> DataFrame:
    """Row counts of the tables (A1)."""
    names = {"captures": t.events, "posts": t.orders, "users": t.customer, "forums": t.nation, "pages": t.pages, "documents": t.documents}
    rows = None
    for name, df in names.items():
        n = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        rows = n if rows is None else rows.union(n)
    return rows.agg(*[F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in names])


@query(f"""WITH {CAPTURES} SELECT kind, count(*) AS queued, count(*) FILTER (WHERE value >= 20) AS downloaded, count(*) FILTER (WHERE value < 20) AS failed, count(*) FILTER (WHERE user_id % 5 = 0) AS skipped, CAST(sum(CAST(floor(value) AS BIGINT)) FILTER (WHERE value >= 20) AS BIGINT) AS bytes FROM captures GROUP BY kind""")
def download_counters(t: Tables) -> DataFrame:
    """Counters of a download run."""
    whole = F.floor("value").cast("bigint")
    results = t.captures().select("kind", F.when(F.col("value") < 20, "status 404").alias("error"), F.when(F.col("value") >= 20, whole).alias("retrieved_length"), (F.col("user_id") % 5 == 0).alias("skipped"))
    return harvest.counters(results, F.count_if("skipped"), ["kind"])


@query(f"""WITH {CAPTURES}, r AS (SELECT capture_id, user_id, CASE WHEN kind = 'view' THEN user_id || ':' || timestamp ELSE user_id::VARCHAR END AS identity, timestamp FROM captures)
SELECT identity, arg_min(capture_id, timestamp || lpad(capture_id::VARCHAR, 12, '0')) AS target, count(*) AS captures FROM r GROUP BY identity""")
def blob_targets(t: Tables) -> DataFrame:
    """One copy per content; style sheets also by time."""
    identity = F.when(F.col("kind") == "view", F.concat_ws(":", F.col("user_id").cast("string"), "timestamp")).otherwise(F.col("user_id").cast("string"))
    return relations.first_of_identity(t.captures(), identity, "capture_id", ["timestamp", "capture_id"]).withColumnRenamed("capture_id", "target")


@query(f"""WITH {CAPTURES} SELECT user_id AS capture, min(kind) AS alias, min(kind || lpad(capture_id::VARCHAR, 12, '0')) AS first_alias FROM captures GROUP BY user_id""")
def first_alias(t: Tables) -> DataFrame:
    """First alias of each capture in a fixed order."""
    rows = t.captures().withColumn("first_alias", F.concat("kind", F.lpad(F.col("capture_id").cast("string"), 12, "0")))
    found = relations.first_of_identity(rows, F.col("user_id"), "first_alias", ["kind", "capture_id"])
    return found.select(F.col("identity").alias("capture"), F.expr("left(first_alias, length(first_alias) - 12)").alias("alias"), "first_alias")


@query("SELECT conv_id AS topic_id, turn AS post_id, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS previous_role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM conversations")
def control_break(t: Tables) -> DataFrame:
    """Posts of each topic in order with their predecessor."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    return t.conversations.select(F.col("conv_id").alias("topic_id"), F.col("turn").alias("post_id"), "role", F.lag("role").over(w).alias("previous_role"), F.row_number().over(w).cast("bigint").alias("position"))
