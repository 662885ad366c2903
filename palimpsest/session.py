"""Session helpers."""

from __future__ import annotations

import ctypes
import os
import re
import uuid
from collections.abc import Callable
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
#: For the C library's and Arrow's allocation in Python workers.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20)}


def ensure_importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; on a cluster ship it with --py-files."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_importable(spark)
        return query(spark, sf_dir)

    return run


def lean_workers(spark: SparkSession) -> None:
    """Python workers that start from now on give large blocks back to the machine as soon as they are free."""
    for key, own in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(key, own)


def release_memory() -> None:
    """Give what a Python worker has freed back to the machine; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; without it one under /tmp, in local mode only."""
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file:///tmp/palimpsest-checkpoints"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` in the shared folder and read it back: cuts lineage in a way that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/palimpsest/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
