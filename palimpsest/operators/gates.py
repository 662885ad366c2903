"""Integrity gates: named conditions over frames, reported with offending rows or raised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class IntegrityError(ValueError):
    """A gate failed; ``sample`` holds a few offending rows."""

    def __init__(self, message: str, sample: list | None = None):
        super().__init__(message)
        self.sample = sample or []


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows that break a rule, with the names of the rules they break; null breaks a rule."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return df.withColumn("broken", broken).where(F.size("broken") > 0)


def require_none(df: DataFrame, message: str, sample: int = 5) -> None:
    """Raise with a bounded sample if the frame has a row."""
    rows = df.limit(sample).collect()
    if rows:
        raise IntegrityError(f"{message}: {rows[0].asDict()}", rows)


def require_some(df: DataFrame, message: str) -> None:
    if df.isEmpty():
        raise IntegrityError(message)


def the_row(df: DataFrame, message: str):
    """The row that a point lookup finds; raises where there is none or more than one."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise LookupError(f"{message}: {'no row' if not rows else 'several rows'}")
    return rows[0]


def unmatched(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is set but unknown to the parent."""
    known = child
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.join(parent.select(*keys).distinct(), keys, "left_anti")


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).where("occurrences > 1")
