"""Current state of a change table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcmart.sources.specs import TableSpec

STORED = {
    "id": "bigint",
    "id?": "bigint",
    "int": "int",
    "str": "string",
    "str?": "string",
    "money": "decimal(15,2)",
    "money?": "decimal(15,2)",
    "float?": "double",
    "time": "timestamp",
    "time?": "timestamp",
    "flag+": "int",
}


#: Columns that order the changes of a key when a topic has several partitions: the time at
#: the source, then partition and offset, which decide between changes of one instant.
SEVERAL_PARTITIONS = ("_source_ts_ms", "partition", "_version")


def _list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def current_state(
    changes: DataFrame,
    keys: str | Sequence[str] = "id",
    version: str | Sequence[str] = "_version",
    *,
    include_deleted: bool = False,
) -> DataFrame:
    """The newest row per key, tombstones removed unless asked for.

    Offsets order the changes of a topic with one partition. For more partitions pass
    several version columns (source time, partition, offset).

    The tombstone filter comes after the pick: an older live row must not reappear
    when the newest one is a delete. Re-delivered changes have the same version, so
    reading a log twice gives the same rows. Spark keeps one row per key and task
    before the shuffle (WindowGroupLimit), so a key with very many changes costs the
    shuffle no more than any other.
    """
    order = [F.col(name).desc() for name in _list(version)]
    newest = Window.partitionBy(*_list(keys)).orderBy(*order)
    latest = changes.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
    return latest if include_deleted else latest.where(F.col("_deleted") == 0)


def compact(
    changes: DataFrame, keys: str | Sequence[str] = "id", version: str | Sequence[str] = "_version"
) -> DataFrame:
    """A change table reduced to its newest versions. Tombstones stay, so a late older
    change cannot bring a deleted row back. Write the result to a new place
    (``sources.log.publish``); never over the table being read."""
    return current_state(changes, keys, version, include_deleted=True)


def base_and_changes(
    base: DataFrame, changes: DataFrame, keys: str | Sequence[str] = "id", version: str | Sequence[str] = "_version"
) -> DataFrame:
    """Current rows of a compacted ``base`` and the changes since.

    A change that is older than the base's row of its key must not win. So the newest change of each key
    is held against the base's version, of which only key and version columns are read; a base
    row counts unless a newer change exists. Filters reach the base's scan. Where the base is bucketed by the key
    (``sources.base``), none of its rows is moved.
    """
    names, order = _list(keys), _list(version)
    newest = current_state(changes, names, order, include_deleted=True)
    told = newest.select(*names, F.struct(*order).alias("_told")).hint("merge")
    known = base.select(*names, F.struct(*order).alias("_known"))
    newer = [F.col(f"b.{k}") == F.col(f"c.{k}") for k in names] + [F.col("_told") > F.struct(*[F.col(f"b.{v}") for v in order])]
    kept = base.where(F.col("_deleted") == 0).alias("b").join(told.alias("c"), newer, "left_anti").select(*base.columns)
    older = [F.col(f"b.{k}") == F.col(f"c.{k}") for k in names] + [F.col("_known") >= F.struct(*[F.col(f"c.{v}") for v in order])]
    wins = newest.alias("c").join(known.hint("merge").alias("b"), older, "left_anti").select(*newest.columns)
    return kept.unionByName(wins.where(F.col("_deleted") == 0), allowMissingColumns=True)


def align_schema(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of an older table version in today's columns; added columns read as NULL."""
    return rows.select(
        *[_or_null(rows, name, STORED[kind]) for name, kind in spec.fields],
        *[_or_null(rows, name, kind) for name, kind in (("_version", "bigint"), ("_deleted", "int"))],
    )


def _or_null(rows: DataFrame, name: str, kind: str) -> Column:
    value = F.col(name) if name in rows.columns else F.lit(None)
    return value.cast(kind).alias(name)
