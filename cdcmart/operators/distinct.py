"""Exact distinct counts that can be added up over other groupings.

A group's distinct ids are kept as sets: an id's bucket is its range of 32,768 ids, and in a
bucket a group holds a list of positions while there are few, else a bitmap of 4 KB. Sets of
fine groups are merged into those of coarser ones by bitwise or, in any order and as often as needed,
so distinct orders can be counted over products and days from a stored fact, without its lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Positions of a bucket from which a bitmap is smaller than a list.
SPARSE = 1024


def distinct_sets(rows: DataFrame, keys: Sequence[str], id_column: str, sparse: int = SPARSE) -> DataFrame:
    """(keys, bucket, positions, bits) of the ids in each group; one of the two is null. Null ids do not count.

    Copies of an id leave before rows move, and a list is bounded by its bucket.
    """
    told = rows.where(F.col(id_column).isNotNull()).select(
        *keys, F.bitmap_bucket_number(id_column).alias("bucket"), F.bitmap_bit_position(id_column).alias("position")
    )
    listed = told.distinct().groupBy(*keys, "bucket").agg(F.sort_array(F.collect_list("position")).alias("positions"))
    few = listed.where(F.size("positions") <= sparse).withColumn("bits", F.lit(None).cast("binary"))
    many = listed.where(F.size("positions") > sparse).select(*keys, "bucket", F.explode("positions").alias("position"))
    many = many.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("position").alias("bits"))
    return few.unionByName(many.withColumn("positions", F.lit(None).cast("array<bigint>")).select(*few.columns))


def merge_sets(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, bucket, bits): the sets of coarser groups; ``sets`` come from here or from ``distinct_sets``."""
    parts = sets.where("bits IS NOT NULL").select(*keys, "bucket", "bits")
    if "positions" in sets.columns:
        listed = sets.where("bits IS NULL").select(*keys, "bucket", F.explode("positions").alias("position"))
        parts = parts.unionByName(listed.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("position").alias("bits")))
    return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_sets(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct ids per group, for any columns of ``sets`` as keys."""
    return merge_sets(sets, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias(name))
