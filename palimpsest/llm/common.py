"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import lean_workers, shared_folder
from palimpsest.session import release_memory as release_memory


def bounded_batches(spark: SparkSession, records: int = 2_000, size: str = "16m") -> None:
    """Arrow batches of at most this many records and bytes, where the session has Spark's defaults.

    A task holds a batch on either side of the pipe to its worker; texts make full batches large.
    """
    lean_workers(spark)
    for key, usual, own in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", str(records)), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", size)):
        if spark.conf.get(key, None) == usual:
            spark.conf.set(key, own)


def workdir(spark: SparkSession) -> str:
    """A fresh folder in the shared checkpoint directory.

    The cluster names that directory in ``spark.checkpoint.dir``; only where it is unset, and in
    local mode only, is one under /tmp chosen.
    """
    return f"{shared_folder(spark)}/palimpsest/{uuid.uuid4().hex}"


def materialize(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    The copy survives lost executors.  The schema is handed to the reader, so an empty
    frame can be read again.
    """
    path = workdir(df.sparkSession)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the id as decimal text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def spread(col: Column, seed: int) -> Column:
    """A deterministic hash of an id for ordering samples."""
    return F.xxhash64(col.cast("string"), F.lit(seed))


def window_of(text: Column, chars: int, seed: int) -> Column:
    """The text, or where it is longer than ``chars`` a window of that length at an offset drawn from its hash.

    For samples that go to the driver: any part of a long text may be drawn, not its start.
    """
    start = F.pmod(F.xxhash64(text, F.lit(seed)), F.length(text) - chars + 1).cast("int")
    return F.when(F.length(text) <= chars, text).otherwise(F.substring(text, start + 1, F.lit(chars)))
