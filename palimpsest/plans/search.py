"""Entity pages and full-text search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators import relations
from palimpsest.operators.search import postings, top
from palimpsest.plans.registry import POSTS, Tables, query

TERMS = "terms AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS term FROM documents)"


@query(f"WITH {TERMS} SELECT term, count(DISTINCT doc_id) AS documents, count(*) AS occurrences FROM terms GROUP BY term")
def search_postings(t: Tables) -> DataFrame:
    """Terms with their document and occurrence counts."""
    return postings(t.documents, "doc_id", "text").groupBy("term").agg(F.count("*").alias("documents"), F.sum("n").alias("occurrences"))


@query(f"""WITH {TERMS}, tf AS (SELECT term, doc_id, count(*) AS n FROM terms WHERE term IN ('the', 'que', 'tion') GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), nn AS (SELECT count(*) AS total FROM documents)
SELECT doc_id, score FROM (SELECT doc_id, round(sum((1 + ln(n)) * ln(1 + total / df)), 6) AS score FROM tf JOIN df USING (term), nn GROUP BY doc_id) ORDER BY score DESC, doc_id LIMIT 50""")
def search_top50(t: Tables) -> DataFrame:
    """The 50 best documents for a query (O9); the limit is the feature."""
    return top(t.documents, "doc_id", "text", ["the", "que", "tion"], 50)


@query(f"""WITH {POSTS} SELECT era, topic_id, count(*) AS posts, count(DISTINCT user_id) AS authors, min(posted_at) AS first_posted_at, string_agg(post_id::VARCHAR, ',' ORDER BY posted_at NULLS FIRST, post_id) AS post_ids FROM posts GROUP BY era, topic_id""")
def topic_pages(t: Tables) -> DataFrame:
    """Posts of each topic in page order (J18, J21, K8, O6), keyed by era and topic."""
    ids = relations.joined_in_order(["posted_at", "post_id"], F.col("post_id").cast("string"), ",")
    return t.posts().groupBy("era", "topic_id").agg(F.count("*").alias("posts"), F.count_distinct("user_id").alias("authors"), F.min("posted_at").alias("first_posted_at"), ids.alias("post_ids"))


@query("SELECT n_nationkey AS forum_id, n_name AS name, r_name AS category, count(c_custkey) AS topics FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3")
def forum_pages(t: Tables) -> DataFrame:
    """Forums with their topics."""
    forums = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("forum_id"), F.col("n_name").alias("name"), F.col("r_name").alias("category"))
    return relations.with_count(forums, t.customer.withColumnRenamed("c_nationkey", "forum_id"), "forum_id", "topics")
