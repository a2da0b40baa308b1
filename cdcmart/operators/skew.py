"""Joins and rankings that survive one key holding a large share of all rows.

A join that hashes on the key sends every row of a key to one task. Here keys that a
sample shows to be hot are looked up through a broadcast instead, and their rows, like
rows without a key, are spread over all tasks. All rows stay in the result: sampling
decides only which way a row travels.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcmart.session import size_bytes

SAMPLE = 1024  # one row in this many is looked at, chosen by a hash of its id
SEEN = 64  # sampled rows that make a key hot: about 65,000 rows of the whole
HOT_KEYS = 50_000  # upper bound of the broadcast; a colder key holds under a 50,000th of all rows
GROWTH = 4  # how much wider a lookup table may be than the tables it is read from
UNKNOWN = 1 << 62


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate (file sizes, scaled by the columns read)."""
    plan = getattr(df, "_jdf", None)
    if plan is None:  # no local optimizer to ask: treat as large
        return UNKNOWN
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _source_bytes(df: DataFrame) -> int:
    """Total size of the tables a plan reads."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return UNKNOWN
    leaves = plan.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        total += int(str(leaves.next().stats().sizeInBytes()))
    return total


def _threshold(table: DataFrame) -> int:
    return size_bytes(table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def fits_broadcast(table: DataFrame) -> bool:
    """Whether a lookup table is below the session's broadcast threshold, by Spark's
    estimate or surely (see ``hinted``)."""
    limit = _threshold(table)
    return limit > 0 and (estimated_bytes(table) <= limit or _source_bytes(table) * GROWTH <= limit)


def hinted(table: DataFrame) -> DataFrame:
    """A lookup table as the side of a join, with a broadcast hint where that is safe.

    Below the threshold by Spark's own estimate no hint is given: Spark broadcasts by
    itself and can still change its mind when the real size shows. But Spark estimates a join
    as the product of its sides. Lookup tables are made by adding columns of small tables to
    another one, never rows, so they cannot outgrow a few times the files that they are
    read from; where that is below the threshold, the hint cannot go wrong.
    """
    limit = _threshold(table)
    if limit > 0 and estimated_bytes(table) > limit and _source_bytes(table) * GROWTH <= limit:
        return F.broadcast(table)
    return table


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    *,
    sample: int | None = None,
    seen: int | None = None,
    limit: int | None = None,
) -> DataFrame:
    """At most ``limit`` keys, hottest first, found in a sample of one row in ``sample``.

    A key is hot from about ``sample`` * ``seen`` rows on, which should be what a task can well
    take; the defaults are ``SAMPLE``, ``SEEN`` and ``HOT_KEYS``.

    The sample is a function of the row's own id, so every evaluation of the plan,
    also after a lost executor, finds the same keys.
    """
    sampled = df.where(F.pmod(F.xxhash64(*row_id), F.lit(sample or SAMPLE)) == 0)
    return (
        sampled.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("_seen"))
        .where(F.col("_seen") >= (seen or SEEN))
        .orderBy(F.desc("_seen"), *keys)
        .limit(limit or HOT_KEYS)
        .select(*keys)
    )


def _sides(rows: DataFrame, table: DataFrame, keys: dict[str, str], columns: dict[str, str]):
    names = [f"_k{i}" for i in range(len(keys))]
    side = table.select(
        *[F.col(theirs).alias(name) for theirs, name in zip(keys.values(), names)],
        *[F.col(source).alias(f"_v_{name}") for name, source in columns.items()],
    )
    return names, side, [F.col(ours) == F.col(name) for ours, name in zip(keys, names)]


def lookup_join(
    rows: DataFrame, table: DataFrame, keys: dict[str, str], columns: dict[str, str], how: str = "left"
) -> DataFrame:
    """Add columns of ``table`` to ``rows``; ``table`` holds each key at most once.

    ``keys`` maps columns of ``rows`` to columns of ``table``, ``columns`` maps new
    names to columns of ``table``.

    A table checked to be below the broadcast threshold is broadcast. A larger one is
    sort-merge joined, and because no caller relies on how the result is partitioned,
    adaptive execution is free to split the rows of an overfull partition among tasks.
    """
    _, side, on = _sides(rows, table, keys, columns)
    side = hinted(side)
    return rows.join(side, on, how).select(*rows.columns, *[F.col(f"_v_{name}").alias(name) for name in columns])


def spread_lookup_join(
    rows: DataFrame,
    table: DataFrame,
    keys: dict[str, str],
    columns: dict[str, str],
    row_id: Sequence[str],
    how: str = "left",
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """``lookup_join`` for rows read straight from a large table.

    Hot keys are answered from a broadcast of at most ``HOT_KEYS`` table rows. Their
    rows, like rows with a NULL key, then carry a random-looking extra join column,
    which spreads them evenly and lets them match nothing further. ``row_id`` identifies
    a row.

    Hot keys are looked for in ``keys_from`` (default ``rows``), which is read a second
    time, key and id columns only: pass the base table when ``rows`` is the result of
    work that should not be repeated. A table small enough to broadcast needs none of this.
    """
    key_names, side, on = _sides(rows, table, keys, columns)
    if fits_broadcast(side):
        return lookup_join(rows, table, keys, columns, how)
    hot = hot_keys(rows if keys_from is None else keys_from, list(keys), row_id).toDF(*key_names)
    hot_side = side.join(F.broadcast(hot), key_names, "left_semi").select(
        *[F.col(name).alias(f"_h{name}") for name in key_names],
        *[F.col(f"_v_{name}").alias(f"_hv_{name}") for name in columns],
        F.lit(True).alias("_hit"),
    )
    hot_on = [F.col(ours) == F.col(f"_h{name}") for ours, name in zip(keys, key_names)]
    keyless = reduce(lambda a, b: a | b, [F.col(ours).isNull() for ours in keys])
    spread = F.when(F.col("_hit").isNotNull() | keyless, F.pmod(F.xxhash64(*row_id), F.lit(1 << 30)) + 1)
    answered = rows.join(F.broadcast(hot_side), hot_on, "left").withColumn(
        "_spread", F.coalesce(spread, F.lit(0)).cast("bigint")
    )
    # Always 0, but computed from the key so that it stays a join column.
    cold_side = side.withColumns(
        {"_zero": F.pmod(F.xxhash64(*key_names), F.lit(1)).cast("bigint"), "_found": F.lit(True)}
    )
    joined = answered.join(cold_side, [*on, F.col("_spread") == F.col("_zero")], "left")
    if how == "inner":
        joined = joined.where(F.col("_hit").isNotNull() | F.col("_found").isNotNull())
    return joined.select(
        *rows.columns,
        *[
            F.when(F.col("_hit").isNotNull(), F.col(f"_hv_{name}")).otherwise(F.col(f"_v_{name}")).alias(name)
            for name in columns
        ],
    )


def rank_descending(rows: DataFrame, group: str, number: str, name: str, bits: int = 20) -> DataFrame:
    """Rank within ``group`` by a unique whole ``number``, largest first, without ever
    putting a whole group into one task.

    The number range is cut into slices of 2^bits; a slice holds at most that many rows
    because numbers are unique. Slices are counted first, slices of slices are counted
    from those, and running counts are added from the top down.
    """
    fine, coarse = F.shiftright(F.col(number), bits), F.shiftright(F.col("_fine"), bits)
    sliced = rows.withColumn("_fine", fine)
    counts = sliced.groupBy(group, "_fine").agg(F.count("*").alias("_n")).withColumn("_coarse", coarse)
    blocks = counts.groupBy(group, "_coarse").agg(F.sum("_n").alias("_n"))
    before_block = _running(blocks, [group], "_coarse", "_before_block")
    before_slice = _running(counts, [group, "_coarse"], "_fine", "_before_slice")
    offsets = before_slice.join(before_block.drop("_n"), [group, "_coarse"]).select(
        group, "_fine", (F.col("_before_slice") + F.col("_before_block")).alias("_before")
    )
    within = Window.partitionBy(group, "_fine").orderBy(F.col(number).desc())
    ranked = sliced.withColumn("_within", F.row_number().over(within)).join(offsets, [group, "_fine"])
    return ranked.select(*rows.columns, (F.col("_before") + F.col("_within")).cast("bigint").alias(name))


def _running(counts: DataFrame, group: list[str], order: str, name: str) -> DataFrame:
    above: Column = F.sum("_n").over(
        Window.partitionBy(*group).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.withColumn(name, F.coalesce(above, F.lit(0)))
