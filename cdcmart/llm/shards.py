"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards, each with a weight; an inner node weighs what its
shards weigh. A key descends level by level. At a node every child draws
``-ln(u) / weight`` with ``u`` hashed from the key and the child's name, and the least draw
wins, so children win in proportion to their weights. When weights change, the draws of the
other children stay what they were: keys move only between subtrees whose weight changed.
A shard added as a region of its own changes no other weight, so it takes rows only into
itself.

A null key is a key like any other; repeated rows share a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.llm.common import empty_if_null, table

SHARDS = 16


@dataclass(frozen=True)
class Tree:
    """(region, rack, shard, weight) of each shard; names must be unique on their level."""

    leaves: tuple[tuple[str, str, int, float], ...]

    @staticmethod
    def of(count: int, base: int = SHARDS, racks: int = 4, regions: int = 2) -> Tree:
        """Equal shards: the first ``base`` dealt to racks and regions, each later one alone.

        From ``base`` on, one more shard takes rows only into itself.
        """
        if count < 1:
            raise ValueError("a tree needs a shard")
        leaves = []
        for shard in range(count):
            rack = shard * racks // base if shard < base else racks + shard - base
            region = rack * regions // racks if shard < base else regions + shard - base
            leaves.append((f"region{region}", f"rack{rack}", shard, 1.0))
        return Tree(tuple(leaves))

    def children(self, level: int) -> dict[str, dict[str, float]]:
        """Parent name -> child name -> weight; level 0 holds the regions."""
        found: dict[str, dict[str, float]] = {}
        for region, rack, shard, weight in self.leaves:
            path = ("root", region, rack, str(shard))
            below = found.setdefault(path[level], {})
            below[path[level + 1]] = below.get(path[level + 1], 0.0) + weight
        return found


def _draw(key: Column, child: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(child)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(weight)


def _winner(key: Column, level: int, below: dict[str, float]) -> Column:
    heavy = {name: weight for name, weight in below.items() if weight > 0}
    if len(heavy) == 1:
        return F.lit(next(iter(heavy)))
    draws = [F.struct(_draw(key, f"{level}:{name}", weight).alias("d"), F.lit(name).alias("n")) for name, weight in heavy.items()]
    return F.array_min(F.array(*draws))["n"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard (int) that ``key`` descends to."""
    node: Column | None = None
    for level in range(3):
        parents = {name: below for name, below in tree.children(level).items() if sum(below.values()) > 0}
        if level == 0:
            node = _winner(key, 0, parents["root"])
            continue
        chosen = None
        for name, below in parents.items():
            won = _winner(key, level, below)
            chosen = F.when(node == name, won) if chosen is None else chosen.when(node == name, won)
        node = chosen
    return node.cast("int")


def place(frame: DataFrame, key: str, tree: Tree, into: str = "shard") -> DataFrame:
    """``frame`` with the shard of each row; no shuffle. A column ``into`` is replaced."""
    return frame.withColumn(into, shard_of(F.col(key), tree))


def number(frame: DataFrame, shard: str, order: list[str], into: str = "slot", pieces: int = 256) -> DataFrame:
    """Gapless positions from 0 within each shard.

    Rows are counted by (shard, piece), a piece being a hash of the order columns; a piece's
    rows follow those of the pieces before it, sorted by the order columns. So no task
    sorts a whole shard. Equal rows are interchangeable and share a piece, which is sorted
    on disk when it is large. The counts have shards x ``pieces`` rows at most.
    """
    from pyspark.sql import Window as W

    named = frame.withColumn("__piece", F.pmod(F.xxhash64(*order), F.lit(pieces)))
    counts = named.groupBy(shard, "__piece").agg(F.count("*").alias("__n"))
    before = W.partitionBy(shard).orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        F.col(shard).alias("__shard"), F.col("__piece").alias("__at"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
    )
    within = W.partitionBy(shard, "__piece").orderBy(*order)
    ranked = named.withColumn("__rank", F.row_number().over(within))
    found = ranked.join(
        F.broadcast(starts), F.col(shard).eqNullSafe(F.col("__shard")) & (F.col("__piece") == F.col("__at"))
    )
    columns = [F.col(name) for name in frame.columns if name != into]
    return found.select(*columns, (F.col("__start") + F.col("__rank") - 1).cast("long").alias(into))


def op1_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by the law ``key``. A null text has no bytes (crc32 0)."""
    text = empty_if_null(F.col("text"))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = place(place(rows, "doc_id", Tree.of(SHARDS)), "doc_id", Tree.of(SHARDS + 1), "grown_shard")
    done = number(placed, "shard", ["doc_id", "text_crc32", "size"])
    return done.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
