"""Digests and identities."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(content: Column) -> Column:
    """Base-32 SHA-1 without padding: each five hexadecimal digits are four characters."""
    sha = F.sha1(content)
    out = []
    for i in range(8):
        n = F.conv(F.substring(sha, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def fold_name(name: str | None) -> str:
    """Case-folded, without combining marks, trimmed."""
    plain = unicodedata.normalize("NFKD", (name or "").casefold())
    return "".join(c for c in plain if not unicodedata.combining(c)).strip()


@F.pandas_udf(T.StringType())
def normalize_username(names: pd.Series) -> pd.Series:
    return names.map(fold_name)


def user_identity(era: Column, historical_id: Column, norm: Column) -> Column:
    return F.when(historical_id.isNotNull(), F.concat_ws(":", F.lit("id"), era, historical_id.cast("string"))).otherwise(F.concat_ws(":", F.lit("name"), era, norm))


def post_identity(era: Column, historical_id: Column, topic_id: Column, norm: Column, posted_at: Column, raw_date: Column, body: Column) -> Column:
    """SHA-256 of the era-scoped id, or without one of what the post says."""
    given = F.concat_ws(":", F.lit("historical"), era, historical_id.cast("string"))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    said = F.concat_ws(chr(31), F.lit("content"), text(era), F.when(topic_id == 0, "").otherwise(text(topic_id)), text(norm), F.coalesce(F.nullif(posted_at, F.lit("")), raw_date, F.lit("")), text(body))
    return F.sha2(F.when(historical_id.isNotNull(), given).otherwise(said), 256)


def evidence_identity(era: Column, role: Column, topic_id: Column, norm: Column, posted_at: Column) -> Column:
    day = F.coalesce(F.nullif(F.substring(posted_at, 1, 10), F.lit("")), F.lit("unknown"))
    author = F.concat_ws(":", era, F.lit("author"), topic_id.cast("string"), norm)
    return F.when(role == "topic_author", author).otherwise(F.concat_ws(":", era, F.lit("last"), topic_id.cast("string"), norm, day))
