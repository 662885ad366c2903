"""Sinks: JSON Lines, routed results, reports and site trees."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import materialize


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Compact JSON Lines, characters as they are; ``order`` sorts across files."""
    rows = df.orderBy(*order) if order else df
    rows.select(F.to_json(F.struct(*df.columns)).alias("value")).write.text(path)


def route_results(df: DataFrame, rows_path: str, failures_path: str) -> None:
    """Two outputs of one frame (``row``, ``failure``): successes and failures, appended.

    The frame is written once first, so that what it fetches is fetched once.
    """
    df = materialize(df)
    df.where("row IS NOT NULL").select("row.*").write.mode("append").json(rows_path)
    df.where("failure IS NOT NULL").select("failure.*").write.mode("append").json(failures_path)


def publish(df: DataFrame, base: str) -> str:
    """Write a new version beside the old ones, then name it in the file ``base/CURRENT``.

    The pointer is written aside and renamed over the old one, so readers never see half a version.
    """
    version = uuid.uuid4().hex
    df.write.parquet(f"{base}/versions/{version}")
    spark = df.sparkSession
    fs = spark._jvm.org.apache.hadoop.fs
    temporary, pointer = fs.Path(f"{base}/CURRENT.{version}"), fs.Path(f"{base}/CURRENT")
    out = temporary.getFileSystem(spark._jsc.hadoopConfiguration()).create(temporary)
    out.write(f"{version}\n".encode())
    out.close()
    overwrite = spark._sc._gateway.new_array(fs.Options.Rename, 1)
    overwrite[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration()).rename(temporary, pointer, overwrite)
    return version


def current(spark, base: str) -> DataFrame:
    version = spark.read.text(f"{base}/CURRENT").first().value
    return spark.read.parquet(f"{base}/versions/{version}")


def build_report(metrics: DataFrame) -> str:
    """One row of metrics as JSON with sorted keys."""
    return json.dumps(metrics.first().asDict(), sort_keys=True, ensure_ascii=False, default=str)


def write_files(df: DataFrame, base: str) -> int:
    """(path, content) as files through Hadoop's file system of ``base``; the first of equal paths counts.

    Each partition writes its own files under a temporary name and renames them.
    """
    from pyspark.sql import SparkSession

    spark: SparkSession = df.sparkSession
    rows = df.groupBy("path").agg(F.min("content").alias("content"))
    local = base.removeprefix("file://")
    if "://" in local:
        # remote stores: one Parquet dataset partitioned for a copier, since executors have no portable client
        rows.write.mode("overwrite").parquet(base)
        return spark.read.parquet(base).count()

    def run(batches):
        import os

        import pandas as pd

        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                if path.startswith("/") or ".." in path.split("/"):
                    raise ValueError(f"path outside the site: {path}")
                to = os.path.join(local, path)
                os.makedirs(os.path.dirname(to), exist_ok=True)
                with open(f"{to}.part", "wb") as f:
                    f.write(content if isinstance(content, bytes) else content.encode())
                os.replace(f"{to}.part", to)
            yield pd.DataFrame({"n": [len(pdf)]})

    return rows.mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
