"""Streams of captures: resumable downloads and running latest-capture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palimpsest.operators.merge import latest_wins
from palimpsest.sources import harvest

INVENTORY = "timestamp string, original_url string, statuscode int, mimetype string, digest string, length long"


def download(spark: SparkSession, inventory_dir: str, out_dir: str, fetcher: harvest.Fetcher, checkpoint: str, **options) -> StreamingQuery:
    """Fetch what appears in ``inventory_dir`` and isn't in ``out_dir`` yet; stops when all is read.

    The checkpoint remembers files that were read; the anti-join makes a repeated batch harmless.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        done = session.read.schema(harvest.RESULT).parquet(out_dir) if _exists(session, out_dir) else session.createDataFrame([], harvest.RESULT)
        todo = harvest.pending(rows.dropDuplicates(["timestamp", "original_url"]), done.where("error IS NULL"))
        harvest.fetch(todo, fetcher, **options).write.mode("append").parquet(out_dir)

    source = spark.readStream.schema(INVENTORY).option("maxFilesPerTrigger", 100).json(inventory_dir)
    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def latest_captures(stream: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Running winner of each key by ``timestamp``; of equally old captures the least ``capture_id``."""
    best = F.max_by(F.struct(*columns), F.struct("timestamp", (-F.col("capture_id")).alias("neg")))
    return stream.groupBy(key).agg(F.max("timestamp").alias("timestamp"), best.alias("w")).select(key, "timestamp", *[F.col(f"w.{c}").alias(c) for c in columns])


def activity_windows(stream: DataFrame, time_col: str, every: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events per window and kind; what is later than ``late`` is dropped."""
    return stream.withWatermark(time_col, late).groupBy(F.window(time_col, every), "kind").agg(F.count("*").alias("n"))


def merge_batch(rows: DataFrame, batch_id: int, base: str) -> None:
    """``foreachBatch`` body: the merged table of what is there and the new rows, published as a version."""
    from palimpsest.sources import sinks

    spark = rows.sparkSession
    if _exists(spark, f"{base}/CURRENT"):
        rows = rows.unionByName(sinks.current(spark, base))
    rest = [c for c in rows.columns if c not in ("identity", "timestamp")]
    sinks.publish(latest_wins(rows, ["identity"], "timestamp", ["capture_id"], rest), base)
