"""Steps of a restoration as functions of frames and column names; plans and catalogue share them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Media types of pages and of style sheets.
HTML = ("text/html", "application/xhtml+xml")
CSS = "text/css"
#: Rows that one task joins and merges; more rows make more tasks, not larger ones.
TASK_ROWS = 1 << 19


def role(mimetype: Column) -> Column:
    """What becomes of a payload: ``page``, ``stylesheet`` or ``stored``."""
    return F.when(mimetype.isin(*HTML), "page").when(mimetype == CSS, "stylesheet").otherwise("stored")


def within(time: Column, start: str, end: str) -> Column:
    """Is the time in the period, both ends included?  Unknown times aren't."""
    return F.coalesce(time.between(start, end), F.lit(False))


def first_known(value: str, order: Sequence[str]) -> Column:
    """The first value that isn't null, in ``order``."""
    return F.min(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_v"))))["_v"]


def last_known(value: str, order: Sequence[str]) -> Column:
    return F.max(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_v"))))["_v"]


def seen(time: str = "timestamp") -> list[Column]:
    return [F.min(time).alias("first_seen"), F.max(time).alias("last_seen")]


def merge_known(rows: DataFrame, key: Sequence[str], order: Sequence[str], last: dict[str, str], first: dict[str, str] | None = None, more: Sequence[Column] = ()) -> DataFrame:
    """One row per key: of each column the last (or first) known value in ``order``.

    ``last`` and ``first`` map output names to columns; ``more`` are further aggregates.
    """
    out = [last_known(c, order).alias(n) for n, c in last.items()] + [first_known(c, order).alias(n) for n, c in (first or {}).items()]
    return rows.groupBy(*key).agg(*out, *more)


def merge_users(rows: DataFrame, identity: str, place: Sequence[str], names: Sequence[str], by_id: Column, first: Sequence[str] = ()) -> DataFrame:
    """One row per identity (U6): the last ``names`` of users with an id, the first of users known by
    name; of the columns in ``first`` the first known value."""
    got = rows.groupBy(identity).agg(F.max_by(F.struct(*names), F.struct(*place)).alias("_l"), F.min_by(F.struct(*names), F.struct(*place)).alias("_f"), *[first_known(c, place).alias(c) for c in first])
    chosen = F.when(by_id, F.col("_l")).otherwise(F.col("_f"))
    return got.select(identity, *first, *[chosen[n].alias(n) for n in names])


def provenance(entities: DataFrame, bridge: DataFrame, key: str) -> DataFrame:
    """The distinct rows of ``bridge`` whose entity exists.

    ``bridge`` is counted first (of files, footers only): left alone, Spark merges its shuffle to about
    a task for each core, however many rows that is.  A semi-join would be pushed below the
    repartition, whose number Spark then doesn't keep.
    """
    spark = bridge.sparkSession
    n = max(spark.sparkContext.defaultParallelism, -(-bridge.count() // TASK_ROWS))
    return bridge.repartition(n, key).join(entities.select(key).repartition(n, key).distinct(), key).distinct()


def proofs(entities: DataFrame, bridge: DataFrame, captures: DataFrame, key: str, capture: str) -> DataFrame:
    """Entities beside the captures that they were read from."""
    return bridge.join(captures, capture).join(entities, key)


def activity(*parts: DataFrame) -> DataFrame:
    """Posts and evidence together; rows of unknown time don't count (SET union)."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.where("posted_at IS NOT NULL")


def with_activity(entities: DataFrame, rows: DataFrame, key: Sequence[str], first: Column | None = None, last: Column | None = None) -> DataFrame:
    """``entities`` with the extremes of their activity, else with those that listings tell (A3, A4)."""
    spans = rows.groupBy(*key).agg(F.min("posted_at").alias("_lo"), F.max("posted_at").alias("_hi"))
    out = entities.join(spans, list(key), "left")
    lo, hi = [F.col("_lo"), *([] if first is None else [first])], [F.col("_hi"), *([] if last is None else [last])]
    return out.withColumn("first_posted_at", F.coalesce(*lo)).withColumn("last_posted_at", F.coalesce(*hi)).drop("_lo", "_hi")


def refreshed_activity(entities: DataFrame, changed: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``entities`` with the activity of the ``changed`` keys taken anew from ``rows``, nothing else touched (A5)."""
    keys = changed.select(*key).distinct()
    stale = entities.join(keys, list(key), "left_semi").drop("first_posted_at", "last_posted_at")
    anew = with_activity(stale, rows.join(keys, list(key), "left_semi"), key)
    return entities.join(keys, list(key), "left_anti").unionByName(anew.select(*entities.columns))


def with_count(entities: DataFrame, rows: DataFrame, key: str, name: str) -> DataFrame:
    """``entities`` with the number of their rows, 0 without any."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    return entities.join(counts, key, "left").withColumn(name, F.coalesce("_n", F.lit(0))).drop("_n")


def collisions(rows: DataFrame, key: Sequence[str], content: str, shared: Column) -> DataFrame:
    """Keys with several contents, but for those that are shared on purpose."""
    return rows.where(~shared).groupBy(*key).agg(F.count_distinct(content).alias("versions")).where("versions > 1")


def first_found(options: Sequence[DataFrame], key: Sequence[str], value: str) -> DataFrame:
    """For each key the value of the first option that has one (J11); each option has a key once."""
    ranked = None
    for step, option in enumerate(options):
        rows = option.where(F.col(value).isNotNull()).select(*key, value, F.lit(step).alias("_step"))
        ranked = rows if ranked is None else ranked.unionByName(rows)
    return ranked.groupBy(*key).agg(F.min_by(value, "_step").alias(value))


def lost(references: DataFrame, known: DataFrame, on: Sequence[str], exempt: Column) -> DataFrame:
    """References that lead to nothing known and aren't exempt."""
    return references.where(~exempt).join(known.select(*on).distinct(), list(on), "left_anti")


def with_members(asked: DataFrame, known: DataFrame, key: Sequence[str], members: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Known ones of the ``asked`` entities, and the members that they show.

    Each of ``members`` is a frame of entities (columns ``key``) with those of an owner beside
    them, under the names given.
    """
    chosen = asked.distinct().join(known.select(*key).distinct(), list(key), "left_semi")
    out = chosen.select(*key)
    for rows, owner in members:
        owners = chosen.select(*[F.col(k).alias(o) for k, o in zip(key, owner, strict=True)])
        out = out.union(rows.join(owners, list(owner), "left_semi").select(*key))
    return out.distinct()


def newest(rows: DataFrame, preferred: Column, order: Sequence[str]) -> DataFrame:
    """One row: of the preferred ones, else of all, the greatest in ``order``."""
    return rows.withColumn("is_portal", preferred).orderBy(F.desc("is_portal"), *map(F.desc, order)).limit(1)


def answering(rows: DataFrame, own: Column, requested: Column, name: str) -> DataFrame:
    """``rows`` once for their own address and once for the one that was asked for, if that differs."""
    asked = F.when(requested.isNotNull() & ~requested.eqNullSafe(own), requested)
    return rows.withColumn(name, F.explode(F.array_compact(F.array(own, asked))))


def first_of_identity(rows: DataFrame, identity: Column, value: str, place: Sequence[str]) -> DataFrame:
    """identity, the value of its first row in ``place`` and the number of its rows."""
    return rows.groupBy(identity.alias("identity")).agg(F.min_by(value, F.struct(*place)).alias(value), F.count("*").alias("captures"))


def queue_head(rows: DataFrame, rank: Column, order: Sequence[str], n: int) -> DataFrame:
    """The next ``n`` rows of a queue, by rank, then by ``order``."""
    return rows.orderBy(rank, *order).limit(n)


def last_valid(rows: DataFrame, key: Sequence[str], at: str) -> DataFrame:
    """The last row of each key, at the place of its first."""
    rest = [c for c in rows.columns if c not in {*key, at}]
    kept = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), at).alias("_r"), F.min(at).alias(at))
    return kept.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest], at)


def joined_in_order(order: Sequence[str], text: Column, separator: str = "") -> Column:
    """The texts of a group, in order (O6, O7); groups are pages, whose size their readers bound."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, text.alias("_text")))), lambda x: x["_text"]), separator)
