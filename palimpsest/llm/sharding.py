"""K-d tree partitioning into shards of near-equal bytes.

Every row is a point of numeric metadata with a weight, its bytes.  A node that stands for k
shards is cut along its widest dimension (width relative to that dimension's range over all
rows) at the weighted quantile that leaves ceil(k / 2) shards' bytes on one side; nodes of one
shard are leaves, so they hold the target bytes.  All nodes of a level are cut together.

A row's place along a dimension is a 56-bit key: the dimension's value in 2**16 steps of the
node's extent, then a hash of its group (equal texts stand next to each other), then a hash of
its id, which parts even one text that a third of all rows hold.  The quantile is found from
the high bits down by distributed histograms of ``2**BITS`` bins a node; the driver sees at
most (nodes x bins) sums, whatever the input.  A node's descent ends once its bin weighs at
most ``TOLERANCE`` of a shard.

Slots are numbered in sub-ranges: (shard, bucket) counts give offsets, so no task sorts a shard.

Defined results: null text has no bytes and crc 0; null metadata count as -1; rows that agree
in all columns get slots in no particular order; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import materialize, read

BITS, VALUE_BITS, GROUP_BITS, ID_BITS = 12, 16, 16, 24
KEY_BITS = VALUE_BITS + GROUP_BITS + ID_BITS
TOLERANCE = 0.0005
SLOT_ROWS = 50_000


@dataclass
class Node:
    """Shards ``first`` to ``first + count - 1``, to be cut along dimension number ``dim``."""

    first: int
    count: int
    total: int = 0
    dim: int = 0
    low: float = 0.0
    extent: float = 1.0
    cut: int = 0

    @property
    def half(self) -> int:
        return (self.count + 1) // 2


def _placed(rows: DataFrame, nodes: list[tuple[Node, int]], dims: list[str]) -> DataFrame:
    """Rows of these nodes with ``_key``, their 56-bit place along the node's dimension, and the node's ``_goal``.

    The nodes, at most as many as shards, come by a broadcast join; a CASE over them would be
    copied into every condition.
    """
    own = rows.sparkSession.createDataFrame([(n.first, n.dim + 1, n.low, n.extent, goal) for n, goal in nodes], "shard int, _dim int, _low double, _extent double, _goal long")
    steps = (1 << VALUE_BITS) - 1
    place = F.element_at(F.array(*dims), F.col("_dim"))
    value = F.floor((place - F.col("_low")) / F.col("_extent") * steps).cast("long")
    value = F.least(F.greatest(value, F.lit(0).cast("long")), F.lit(steps).cast("long"))
    return rows.join(F.broadcast(own), "shard").withColumn("_key", F.shiftleft(value, GROUP_BITS + ID_BITS) + F.col("_tie"))


def _cuts(rows: DataFrame, nodes: list[Node], dims: list[str], weight: str) -> None:
    """Set each node's ``cut``, the key that parts its bytes in proportion to its halves' shards."""
    goal = {n.first: n.total * n.half / n.count for n in nodes}
    prefix = dict.fromkeys(goal, 0)
    open_, shift = list(nodes), KEY_BITS
    while open_:
        shift, above = max(0, shift - BITS), shift
        bins = _placed(rows, [(n, prefix[n.first]) for n in open_], dims).where(F.shiftright("_key", above) == F.col("_goal"))
        found: dict[int, list[tuple[int, int]]] = {}
        for r in bins.groupBy("shard", F.shiftright("_key", shift).alias("bin")).agg(F.sum(weight).alias("w")).collect():
            found.setdefault(r.shard, []).append((r.bin, r.w))
        left = []
        for n in open_:
            rest, own = goal[n.first], sorted(found[n.first])
            for b, w in own:
                if w > rest or b == own[-1][0]:
                    break
                rest -= w
            prefix[n.first], goal[n.first] = b, rest
            if w <= TOLERANCE * n.total / n.count or shift == 0:
                n.cut = (b + (rest > w / 2)) << shift
            else:
                left.append(n)
        open_ = left


def grow(points: DataFrame, dims: list[str], shards: int, weight: str = "size") -> DataFrame:
    """``points`` (the dims as doubles, the weight, ``_tie``) with the leaf of each row as ``shard``.

    After each level the narrow rows are written with their node, so plans stay small.
    """
    rows = points.withColumn("shard", F.lit(0))
    nodes = [Node(0, shards)]
    whole: list[float] | None = None
    while nodes := [n for n in nodes if n.count > 1]:
        extremes = [f(d).alias(f"{a}{i}") for i, d in enumerate(dims) for f, a in ((F.min, "lo"), (F.max, "hi"))]
        stats = {r.shard: r for r in rows.groupBy("shard").agg(F.sum(weight).alias("total"), *extremes).collect()}
        width = lambda r: [r[f"hi{i}"] - r[f"lo{i}"] for i in range(len(dims))]
        whole = whole or [max((width(r)[i] for r in stats.values()), default=0.0) or 1.0 for i in range(len(dims))]
        full = [n for n in nodes if n.first in stats]
        for n in full:
            r = stats[n.first]
            n.total, n.dim = r.total, max(range(len(dims)), key=lambda i: width(r)[i] / whole[i])
            n.low, n.extent = r[f"lo{n.dim}"], width(r)[n.dim] or 1.0
        if full:
            _cuts(rows, full, dims, weight)
            moved = _placed(rows, [(n, n.cut) for n in full], dims).join(F.broadcast(rows.sparkSession.createDataFrame([(n.first, n.first + n.half) for n in full], "shard int, _right int")), "shard")
            moved = moved.withColumn("shard", F.when(F.col("_key") < F.col("_goal"), F.col("shard")).otherwise(F.col("_right"))).select(*rows.columns)
            rows = materialize(moved.unionByName(rows.where(~F.col("shard").isin([n.first for n in full]))))
        nodes = [child for n in full for child in (Node(n.first, n.half), Node(n.first + n.half, n.count - n.half))]
    return rows


def shard_by_bytes(docs: DataFrame, shards: int, dims: dict[str, Column], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    places = {f"_d{i}": F.coalesce(c.cast("double"), F.lit(-1.0)) for i, c in enumerate(dims.values())}
    points = docs.select(F.col(id_col), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *[c.alias(n) for n, c in places.items()])
    group = F.shiftrightunsigned(F.xxhash64("text_crc32", "size"), 64 - GROUP_BITS)
    own = F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string")), 64 - ID_BITS)
    points = materialize(points.withColumn("_tie", F.shiftleft(group, ID_BITS) + own))
    rows = grow(points, list(places), shards).select(id_col, "size", "text_crc32", "_tie", "shard")
    buckets = max(1, math.ceil(points.count() / (shards * SLOT_ROWS)))
    rows = rows.withColumn("_bucket", F.pmod("_tie", F.lit(buckets)))
    counts = rows.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    offsets = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("_n")).drop("_n")
    number = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_tie", "size")) - 1
    rows = rows.withColumn("_number", number).join(offsets, ["shard", "_bucket"])
    return rows.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("_before") + F.col("_number")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    code = lambda c: F.crc32(F.coalesce(F.col(c), F.lit("")).cast("binary"))
    # equal texts agree in the first two, so only a cut by language or source, or one through the copies themselves, parts them
    dims = {"copies": code("text"), "length": F.log1p(F.coalesce(F.octet_length("text"), F.lit(0))), "lang": code("lang"), "source": code("source")}
    return shard_by_bytes(docs, 40, dims)
