"""Acquisition of captures: inventory minus manifest, fetched by bounded partitions.

The fetcher is a parameter, a function (url) -> (status, headers, body), so no network client
is built in.  Results are appended per run; what is there already isn't fetched again.
"""

from __future__ import annotations

import base64
import hashlib
import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Fetcher = Callable[[str], tuple[int, dict[str, str], bytes]]
RESULT = "timestamp string, original_url string, sha256 string, payload_digest string, retrieved_length long, cdx_digest_matches_payload boolean, path string, content binary, error string"


def retry_delay(headers: dict[str, str], attempt: int) -> float:
    """``Retry-After`` between 1 and 300 seconds, else doubling up to 120."""
    given = headers.get("Retry-After", headers.get("retry-after", ""))
    return float(min(300, max(1, int(given)))) if given.isdecimal() else float(min(120, 2**attempt))


def pending(inventory: DataFrame, manifest: DataFrame, on: tuple[str, ...] = ("timestamp", "original_url")) -> DataFrame:
    """Inventory rows whose (time, address) isn't in the manifest."""
    return inventory.join(manifest.select(*on).distinct(), list(on), "left_anti")


def fetch(rows: DataFrame, fetcher: Fetcher, replay: str = "https://web.archive.org/web/{timestamp}id_/{original_url}", parallel: int = 4, retries: int = 5, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """One result per row: payload, digests and whether the index's digest agrees, or an error."""

    def one(ts: str, url: str, digest: str | None) -> tuple:
        error = ""
        for attempt in range(retries):
            try:
                status, headers, body = fetcher(replay.format(timestamp=ts, original_url=url))
            except OSError as e:
                status, headers, body, error = 0, {}, b"", str(e)
            if status == 200:
                sha = hashlib.sha256(body).hexdigest()
                own = base64.b32encode(hashlib.sha1(body).digest()).decode()
                return ts, url, sha, own, len(body), own == digest, f"blobs/{sha[:2]}/{sha}", body, None
            error = error or f"status {status}"
            if status and status not in (429, 500, 502, 503, 504):
                break
            if attempt + 1 < retries:
                sleep(retry_delay(headers, attempt))
        return ts, url, None, None, None, None, None, None, error

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame([one(t, u, d) for t, u, d in zip(pdf["timestamp"], pdf["original_url"], pdf["digest"], strict=True)], columns=[c.split()[0] for c in RESULT.split(", ")]).convert_dtypes(convert_string=False, convert_floating=False)

    return rows.select("timestamp", "original_url", "digest").repartition(parallel, "timestamp", "original_url").mapInPandas(run, RESULT)


def counters(results: DataFrame, skipped: int | Column, by: list[str] | None = None) -> DataFrame:
    """queued, downloaded, failed, skipped, bytes of a run, or of each group of it."""
    ok = F.col("error").isNull()
    skipped = F.lit(skipped) if isinstance(skipped, int) else skipped
    return results.groupBy(*(by or [])).agg(F.count("*").alias("queued"), F.count_if(ok).alias("downloaded"), F.count_if(~ok).alias("failed"), skipped.alias("skipped"), F.coalesce(F.sum("retrieved_length"), F.lit(0)).alias("bytes"))
