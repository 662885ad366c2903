"""Nearest-in-time joins in two sorts of bounded ranges, whatever the number of candidates per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranges(df: DataFrame, place: Column) -> list[float]:
    """Times that cut all rows into about as many ranges as shuffles have partitions."""
    n = max(1, min(1000, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    cuts = df.agg(F.percentile_approx(place, [i / n for i in range(1, n)] or [0.5], 1000)).first()[0]
    return sorted(set(cuts or []))


def nearest_asof(probes: DataFrame, candidates: DataFrame, on: list[str], ts: str, tie: list[str], payload: list[str], seconds=None) -> DataFrame:
    """``probes`` with the payload of the candidate of their key that is nearest in time.

    Only the last candidate before the probe (of equal times the greatest in ``tie``) and the
    first at or after it (the least in ``tie``) compete; of equally near ones the earlier wins.
    A probe without time takes the last candidate.  ``seconds`` turns a time column into a
    number for distances; by default times are 14-digit strings.  Times must order alike as they
    are and as numbers; candidates without time are never taken.

    Each key's line is cut into ranges of time, which borrow the nearest candidates of their
    neighbours, so a key with a third of all rows is spread over as many tasks as ranges.
    """
    seconds = seconds or (lambda c: F.unix_timestamp(c, "yyyyMMddHHmmss"))
    own = [c for c in probes.columns if c not in {*on, ts}]
    found = F.struct(F.col(ts).alias("ts"), *[F.col(c) for c in dict.fromkeys((*tie, *payload))])
    lacking = F.lit(None).cast(candidates.select(found.alias("c")).schema["c"].dataType)
    left = probes.select(*on, F.col(ts).alias("_ts"), F.lit(0).alias("_side"), F.struct(*own).alias("_probe"), lacking.alias("_found"))
    right = candidates.where(F.col(ts).isNotNull()).select(*on, F.col(ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(left.schema["_probe"].dataType).alias("_probe"), found.alias("_found"))
    both = left.unionByName(right)
    place = F.col("_ts").cast("double")
    cuts = _ranges(both, place)
    # the number of cuts up to the time; rows without time come last
    number = F.when(place.isNull(), len(cuts) + 1).otherwise(F.aggregate(F.array(*map(F.lit, cuts)), F.lit(0), lambda n, c: n + (c <= place).cast("int")) if cuts else F.lit(0))
    both = both.withColumn("_range", number)
    edge = F.struct(F.col("_ts").alias("ts"), F.col("_found").alias("found"))
    ends = both.groupBy(*on, "_range").agg(F.min(F.when(F.col("_side") == 1, edge)).alias("lo"), F.max(F.when(F.col("_side") == 1, edge)).alias("hi"), F.max(F.col("_side") == 0).alias("asks"))
    # at most one row a range for each key
    order = Window.partitionBy(*on).orderBy("_range")
    ends = ends.withColumn("before", F.last("hi", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    ends = ends.withColumn("behind", F.last("lo", ignorenulls=True).over(Window.partitionBy(*on).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)))
    # a range that asks gets its neighbours' nearest candidates as its own
    lent = ends.where("asks").select(*on, "_range", F.explode(F.array_compact(F.array("before", "behind"))).alias("e"))
    lent = lent.select(*on, F.col("e.ts").alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast(left.schema["_probe"].dataType).alias("_probe"), F.col("e.found").alias("_found"), "_range")
    # a probe stands before the candidates of its own time; candidates follow in their tie order;
    # a probe without time stands after all
    forth = Window.partitionBy(*on, "_range").orderBy(F.col("_ts").asc_nulls_last(), "_side", "_found")
    back = Window.partitionBy(*on, "_range").orderBy(F.col("_ts").desc_nulls_first(), F.desc("_side"), F.desc("_found"))
    near = lambda w: F.last("_found", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    seen = both.unionByName(lent).select("*", near(forth).alias("_p"), near(back).alias("_n"))
    before: Column = seconds(F.col("_ts")) - seconds(F.col("_p.ts"))
    after: Column = seconds(F.col("_n.ts")) - seconds(F.col("_ts"))
    pick = F.when(F.col("_p").isNull(), F.col("_n")).when(F.col("_n").isNull() | (before <= after), F.col("_p")).otherwise(F.col("_n"))
    out = seen.where("_side = 0").withColumn("_pick", pick)
    return out.select(*on, F.col("_ts").alias(ts), *[F.col(f"_probe.{c}").alias(c) for c in own], F.col("_pick.ts").alias(f"nearest_{ts}"), *[F.col(f"_pick.{c}").alias(f"nearest_{c}") for c in payload])
