"""Registration of queries beside their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder, read on demand; times as the archive's strings beside them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def captures(self) -> DataFrame:
        """``events`` as captures: 14-digit times cut to the hour, so that ties occur."""
        stamp = F.date_format(F.date_trunc("hour", F.col("ts").cast("timestamp_ntz")), "yyyyMMddHHmmss")
        return self.events.select(F.col("event_id").alias("capture_id"), F.col("user_id"), stamp.alias("timestamp"), F.col("event_type").alias("kind"), "value")

    def posts(self) -> DataFrame:
        """``orders`` with ``customer`` as posts: topics are customers' nations, times ISO strings."""
        c = self.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("topic_id"), F.col("c_name").alias("author_name"), F.col("c_mktsegment").alias("era"))
        o = self.orders.select(F.col("o_orderkey").alias("post_id"), F.col("o_custkey").alias("user_id"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("posted_at"), F.col("o_orderstatus").alias("status"))
        return o.join(c, "user_id")


#: The same in SQL.
CAPTURES = "captures AS (SELECT event_id AS capture_id, user_id, strftime(date_trunc('hour', ts), '%Y%m%d%H%M%S') AS timestamp, event_type AS kind, value FROM events)"
POSTS = "posts AS (SELECT o_orderkey AS post_id, o_custkey AS user_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS posted_at, o_orderstatus AS status, c_nationkey AS topic_id, c_name AS author_name, c_mktsegment AS era FROM orders JOIN customer ON o_custkey = c_custkey)"


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its name, with its SQL if there is one."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
