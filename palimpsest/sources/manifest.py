"""Capture manifests, CDX exports and the period: scans with explicit schemas and gates."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions.identity import payload_digest
from palimpsest.operators import gates
from palimpsest.operators.merge import conflict_checked
from palimpsest.operators.relations import last_valid

TEXT = ("timestamp", "original_url", "mimetype", "digest", "payload_digest", "sha256", "path", "source", "requested_url", "digest_source", "retrieved_at", "statuscode", "length", "retrieved_length")
FLAGS = ("cdx_digest_matches_payload", "source_record_complete")
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TEXT] + [T.StructField(c, T.BooleanType()) for c in FLAGS])
SOURCES = ("wayback", "commoncrawl", "wayback-availability")
KEY = ["timestamp", "original_url"]

_http = lambda c: c.rlike("^https?://")
_base32 = lambda c: c.rlike("^[A-Z2-7]{32}$")


def _rules() -> dict:
    source, match = F.col("source"), F.col("cdx_digest_matches_payload")
    offered = source == "wayback-availability"
    return {
        "timestamp": F.col("timestamp").rlike("^[0-9]{14}$"),
        "original_url": _http(F.col("original_url")),
        "sha256": F.col("sha256").rlike("^[0-9a-f]{64}$"),
        "digest": _base32(F.col("digest")),
        "payload_digest": _base32(F.col("payload_digest")),
        "path": F.col("path") == F.concat(F.lit("blobs/"), F.substring("sha256", 1, 2), F.lit("/"), F.col("sha256")),
        "mimetype": F.length("mimetype") > 0,
        "source": source.isin(*SOURCES),
        "requested_url": F.when(offered, _http(F.col("requested_url"))).otherwise(F.col("requested_url").isNull()),
        "attestation": F.when(offered, match.isNull() & (F.col("digest_source") == "computed-payload") & (F.col("digest") == F.col("payload_digest"))).otherwise(match.eqNullSafe(F.lit(True))),
        "record_complete": (source != "commoncrawl") | F.col("source_record_complete").eqNullSafe(F.lit(True)),
        "statuscode": F.col("statuscode").try_cast("int").isNotNull(),
        "length": F.col("length").try_cast("bigint").isNotNull(),
        "retrieved_length": F.col("retrieved_length").try_cast("bigint").isNotNull(),
    }


class _Rules:
    """The manifest's rules by name; Columns need a session, so they are built on use."""

    def __getitem__(self, name: str):
        return _rules()[name]

    def values(self):
        return _rules().values()

    def items(self):
        return _rules().items()


ROW_RULES = _Rules()


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a JSON Lines manifest, valid ones only: anything else raises."""
    rows = spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(path)
    gates.require_none(gates.violations(rows, dict(_rules())), "invalid manifest row")
    gates.require_none(gates.repeated(rows, KEY), "repeated capture")
    return rows.withColumn("ord", F.struct("timestamp", "original_url", "sha256"))


def compact_manifest(spark: SparkSession, path: str) -> DataFrame:
    """What can be resumed from: unreadable and invalid rows go, the last valid row of a key stays.

    The order of lines is their file's and offset's; the row stands where its key first was.
    """
    lines = spark.read.text(path).select("value", F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id().alias("line")).alias("at"))
    rows = lines.select("at", F.from_json("value", SCHEMA, {"mode": "PERMISSIVE"}).alias("r")).where("r IS NOT NULL").select("at", "r.*")
    for rule in _rules().values():
        rows = rows.where(F.coalesce(rule, F.lit(False)))
    return last_valid(rows, KEY, "at").withColumnRenamed("at", "ord")


def with_payload(rows: DataFrame, blobs: DataFrame) -> DataFrame:
    """Rows with their ``content`` (J6); ``blobs`` is (sha256, content) or a binaryFile scan."""
    if "sha256" not in blobs.columns:
        blobs = blobs.select(F.regexp_extract("path", "([0-9a-f]{64})$", 1).alias("sha256"), "content")
    return rows.join(blobs, "sha256", "left")


def payload_violations(rows: DataFrame) -> DataFrame:
    """Rows whose payload is missing or doesn't have the digests and length they state."""
    own = payload_digest(F.col("content"))
    return gates.violations(
        rows,
        {
            "content": F.col("content").isNotNull(),
            "sha256": F.sha2("content", 256) == F.col("sha256"),
            "payload_digest": own == F.col("payload_digest"),
            "attestation": ~F.coalesce(F.col("cdx_digest_matches_payload"), F.lit(False)) | (own == F.col("digest")),
            "retrieved_length": F.octet_length("content") == F.col("retrieved_length").try_cast("bigint"),
        },
    )


CDX = ("timestamp", "original", "statuscode", "mimetype", "digest", "length")


def read_cdx(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Records of JSON arrays of arrays whose first row names the columns.

    Strict: unreadable files, missing columns, bad rows and conflicting repeats raise.
    Lenient: they are left out, and the first of conflicting repeats stays.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", "array<array<string>>").alias("rows"))
    head = F.get("rows", F.lit(0))
    good = F.col("rows").isNotNull() & (F.size(F.array_except(F.array(*map(F.lit, CDX)), F.coalesce(head, F.array().cast("array<string>")))) == 0)
    if strict:
        gates.require_none(files.where(~F.coalesce(good, F.lit(False))).select("file"), "unreadable export")
    records = files.where(good).select("file", head.alias("head"), F.posexplode("rows").alias("line", "row")).where("line > 0")
    cell = lambda c: F.get("row", F.array_position("head", c).cast("int") - 1)
    out = records.select("file", "line", cell("timestamp").alias("timestamp"), cell("original").alias("original_url"), cell("statuscode").try_cast("int").alias("statuscode"), cell("mimetype").alias("mimetype"), cell("digest").alias("digest"), cell("length").try_cast("bigint").alias("length"))
    ok = F.coalesce(F.col("timestamp").rlike("^[0-9]{14}$") & _http(F.col("original_url")) & _base32(F.col("digest")), F.lit(False))
    if strict:
        gates.require_none(out.where(~ok), "invalid record")
    return conflict_checked(out.where(ok), KEY, ["file", "line"], strict).drop("file", "line", "versions")


@dataclass(frozen=True)
class Period:
    """A bounded time and the post that proves its end."""

    start: str
    end: str
    post_id: int
    posted_at: str
    capture_timestamp: str
    original_url: str
    digest: str


def read_period(spark: SparkSession, path: str) -> Period:
    raw = json.loads(spark.read.text(path, wholetext=True).first().value)
    e = raw["evidence"]
    p = Period(raw["start"], raw["end"], int(e["post_id"]), e["posted_at"], e["capture_timestamp"], e["original_url"], e["digest"])
    stamp = r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d"
    wrong = not re.fullmatch(stamp, p.start) or not re.fullmatch(stamp, p.end) or p.start > p.end or p.posted_at != p.end
    if wrong or not re.fullmatch(r"\d{14}", p.capture_timestamp) or not re.match("https?://", p.original_url) or not re.fullmatch("[A-Z2-7]{32}", p.digest):
        raise gates.IntegrityError("invalid period")
    return p
