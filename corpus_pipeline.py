"""Training-data pipeline: quality rules, near-duplicates, decontamination, PII, tokens.

Each stage takes (session, documents, folder of the tables), works on all rows that the one
before it kept, and returns the columns of ``documents``; the last returns counts and digests
of each document's tokens.  Stages are written to the shared folder and read back in between.

Defined results: a null or empty text fails the quality rules, so its row goes; of repeated rows,
and of all texts that near duplicates link, one stays, also under equal ids; extra columns pass
to the last stage, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import bpe, decontamination, ngram_join, pii, quality_rules
from palimpsest.llm.common import materialize, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the line field reject go."""
    return quality_rules.keep_good(docs, quality_rules.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document of the least id stays."""
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of the benchmark go."""
    return decontamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal them are replaced; n_chars follows the text."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # less memory for caches than alone: executors still hold what the stages before took
    return bpe.encode_decode(docs, bpe.production_tokenizer(), entries=30_000, chars=1 << 19)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", sanitise),
    ("BPE encoding and decoding", tokenise),
]

#: The line field's trained weights can't be had in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
