"""Transitive closure by frontiers: each round joins only what the round before it reached."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import materialize


def fixpoint(seeds: DataFrame, expand: Callable[[DataFrame], DataFrame], key: list[str]) -> DataFrame:
    """All rows reachable from ``seeds``, with the round that reached them first as ``depth``.

    ``expand`` maps a frontier to candidate rows of the same columns; rows whose key was seen
    are dropped, so cycles end.  Frontiers and the visited set are written to the shared folder.
    """
    columns = seeds.columns
    frontier = materialize(seeds.dropDuplicates(key).withColumn("depth", F.lit(0)))
    seen = frontier
    depth = 0
    while not frontier.isEmpty():
        depth += 1
        found = expand(frontier.select(*columns)).select(*columns).dropDuplicates(key)
        frontier = materialize(found.join(seen.select(*key), key, "left_anti").withColumn("depth", F.lit(depth)))
        seen = materialize(seen.unionByName(frontier)) if depth % 8 == 0 else seen.unionByName(frontier)
    return seen
