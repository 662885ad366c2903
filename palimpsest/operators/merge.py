"""Keyed merges of captures as two partial aggregations, without sorting or upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, key: list[str], ts: str, order: list[str], winner: list[str] = (), coalesced: list[str] = (), first: dict[str, str] | None = None, first_known: list[str] = (), last_known: list[str] = ()) -> DataFrame:
    """One row per key from its captures.

    The winner has the greatest ``ts``; among equals the earliest in ``order`` (a strictly newer
    capture replaces, an equally old one doesn't).  ``winner`` columns come from it, nulls
    included; ``coalesced`` ones from the newest winner-of-its-time with a value; ``first`` maps
    output names to columns of the earliest row in ``order``; ``first_known`` and ``last_known``
    take the first and last value that isn't null in ``order``.

    The first aggregation is by (key, ts), so a key with very many captures is spread.
    """
    place = F.struct(*order)
    at_time = [F.min_by(F.struct(*winner, *coalesced), place).alias("_w"), F.min(place).alias("_o"), F.max(place).alias("_z")]
    at_time += [F.min_by(c, place).alias(f"_f_{n}") for n, c in (first or {}).items()]
    for c in first_known:
        at_time.append(F.min(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_v")))).alias(f"_a_{c}"))
    for c in last_known:
        at_time.append(F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("_v")))).alias(f"_l_{c}"))
    times = df.groupBy(*key, F.col(ts).alias("_ts")).agg(*at_time)
    out = [F.max("_ts").alias(ts)]
    out += [F.max_by(f"_w.{c}", "_ts").alias(c) for c in winner]
    out += [F.max_by(f"_w.{c}", F.when(F.col(f"_w.{c}").isNotNull(), F.col("_ts"))).alias(c) for c in coalesced]
    out += [F.min_by(f"_f_{n}", "_o").alias(n) for n in (first or {})]
    out += [F.min(f"_a_{c}")["_v"].alias(c) for c in first_known]
    out += [F.max(f"_l_{c}")["_v"].alias(c) for c in last_known]
    return times.groupBy(*key).agg(*out)


def dominant(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """The most frequent value of each key; of equally frequent ones the least."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("occurrences"))
    best = F.max(F.struct(F.col("occurrences"), (-F.col(value)).alias("_neg"))).alias("_b")
    return counts.groupBy(*key).agg(best).select(*key, (-F.col("_b._neg")).alias(value), F.col("_b.occurrences").alias("occurrences"))


def argmax_row(df: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """The row of each key that is greatest in ``by``, and how many others it stands for."""
    rest = [c for c in df.columns if c not in {*key, *by}]
    best = F.max(F.struct(*by, *rest)).alias("_b")
    out = df.groupBy(*key).agg(best, (F.count("*") - 1).alias("duplicates"))
    return out.select(*key, *[F.col(f"_b.{c}").alias(c) for c in (*by, *rest)], "duplicates")


def conflict_checked(df: DataFrame, key: list[str], order: list[str], strict: bool = False) -> DataFrame:
    """The first row of each key with the number of its distinct contents; ``strict`` raises on a conflict."""
    rest = [c for c in df.columns if c not in {*key, *order}]
    out = df.groupBy(*key).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("_r"), F.count_distinct(F.struct(*rest)).alias("versions"))
    if strict:
        out = out.withColumn("versions", F.when(F.col("versions") > 1, F.raise_error(F.concat(F.lit("conflicting rows for "), F.to_json(F.struct(*key)))).cast("long")).otherwise(F.col("versions")))
    return out.select(*key, *[F.col(f"_r.{c}").alias(c) for c in (*order, *rest)], "versions")
