"""Postings and ranked retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TERM = "[a-z]{3,}"


def postings(docs: DataFrame, id_col: str, text_col: str, terms: list[str] | None = None) -> DataFrame:
    """(term, id, n): occurrences of terms, counted map-side; ``terms`` restricts them before the shuffle."""
    words = docs.select(F.col(id_col), F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(TERM), F.lit(0))).alias("term"))
    if terms is not None:
        words = words.where(F.col("term").isin(*terms))
    return words.groupBy("term", id_col).agg(F.count("*").alias("n"))


def top(docs: DataFrame, id_col: str, text_col: str, terms: list[str], k: int) -> DataFrame:
    """The ``k`` documents of the greatest sum of (1 + ln tf) ln(1 + N / df)."""
    found = postings(docs, id_col, text_col, terms)
    df = {r.term: r.df for r in found.groupBy("term").agg(F.count("*").alias("df")).collect()}  # at most the query's terms
    total = docs.count()
    weight = F.lit(0.0)
    for term, n in sorted(df.items()):
        weight = F.when(F.col("term") == term, F.log(F.lit(1 + total / n))).otherwise(weight)
    scored = found.groupBy(id_col).agg(F.round(F.sum((1 + F.log("n")) * weight), 6).alias("score"))
    return scored.orderBy(F.desc("score"), id_col).limit(k)
