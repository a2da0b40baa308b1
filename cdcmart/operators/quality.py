"""Keys, references and constraints of the source tables, checked set-wise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdcmart.operators.skew import spread_lookup_join


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """The incoming rows an insert-or-ignore on a unique key would add.

    Of incoming rows with the same key the first by ``order`` is kept. A NULL key never
    conflicts with anything, as with a unique constraint.
    """
    keys = [key] if isinstance(key, str) else list(key)
    keyed = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in keys])
    first = Window.partitionBy(*keys).orderBy(F.col(order).asc())
    candidates = (
        incoming.where(keyed).withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")
    )
    fresh = candidates.join(existing.select(*keys).distinct(), keys, "left_anti").select(*incoming.columns)
    return fresh.unionByName(incoming.where(~keyed))


def without_related(parents: DataFrame, children: DataFrame, reference: str, parent_id: str = "id") -> DataFrame:
    """Parents no child refers to. Children are reduced to their distinct references
    before they are moved, so a parent with very many children costs nothing extra."""
    referred = children.select(F.col(reference).alias("_ref")).distinct()
    return parents.join(referred, F.col(parent_id) == F.col("_ref"), "left_anti")


def resolve_parent(
    children: DataFrame, parents: DataFrame, child_name: str, parent_name: str, target: str, row_id: str
) -> DataFrame:
    """Add the parent's id found by its name; children of unknown parents are dropped.

    A parent name that occurs more than once resolves to its newest id, so children are
    never multiplied.
    """
    named = parents.groupBy(F.col(parent_name).alias("_name")).agg(F.max("id").alias("_id"))
    return spread_lookup_join(children, named, {child_name: "_name"}, {target: "_id"}, [row_id], "inner")


def _named(tables: Mapping[str, DataFrame], wanted: Sequence[tuple[str, str]]) -> dict[str, list[str]]:
    """Table -> columns to look at; every one must be there, or the report would be silent on it."""
    missing = [f"{t}.{c}" for t, c in wanted if t not in tables or c not in tables[t].columns]
    if missing:
        raise ValueError(f"not checked, because missing: {', '.join(sorted(missing))}")
    found: dict[str, list[str]] = {}
    for table, column in wanted:
        found.setdefault(table, []).append(column)
    return found


def _stacked(tables: Mapping[str, DataFrame], wanted: Sequence[tuple[str, str]], kind: str) -> DataFrame:
    """(name, value, n): how often a column, named table.column, holds each value. Each table is read once."""
    parts = []
    for table, columns in _named(tables, wanted).items():
        pairs = [F.struct(F.lit(f"{table}.{c}").alias("name"), F.col(c).cast(kind).alias("value")) for c in columns]
        parts.append(tables[table].select(F.explode(F.array(*pairs)).alias("p")).select("p.*"))
    return reduce(DataFrame.unionByName, parts).groupBy("name", "value").agg(F.count("*").alias("n"))


def foreign_key_report(tables: Mapping[str, DataFrame], keys: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Per reference: rows, NULLs and rows whose target is missing.

    References are counted by value first, so one popular target is one row by the time
    it is joined. Every table is read at most twice: for what it refers to, and as a target.
    """
    zero = F.lit(0).cast("bigint")
    target_of = F.create_map(*[F.lit(x) for table, column, target in keys for x in (f"{table}.{column}", target)])
    counted = _stacked(tables, [key[:2] for key in keys], "bigint").withColumn("target", target_of[F.col("name")])
    _named(tables, [(target, "id") for _, _, target in keys])
    targets = [
        tables[name].select(F.lit(name).alias("target"), F.col("id").cast("bigint").alias("value"), F.lit(True).alias("found"))
        for name in sorted({target for _, _, target in keys})
    ]
    joined = counted.join(reduce(DataFrame.unionByName, targets), ["target", "value"], "left")
    orphan = F.col("value").isNotNull() & F.col("found").isNull()
    found = joined.groupBy(F.col("name").alias("reference"), "target").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), zero).alias("null_count"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), zero).alias("orphan_count"),
    )
    # References of empty tables have a row too.
    spark = next(iter(tables.values())).sparkSession
    listed = spark.createDataFrame([(f"{t}.{c}", target) for t, c, target in keys], "reference string, target string")
    counts = [F.coalesce(name, zero).alias(name) for name in ("row_count", "null_count", "orphan_count")]
    return F.broadcast(listed).join(found, ["reference", "target"], "left").select("reference", "target", *counts)


def unique_report(tables: Mapping[str, DataFrame], columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Per unique column: distinct values, values held more than once, and the rows beyond
    the first of each."""
    zero = F.lit(0).cast("bigint")
    counted = _stacked(tables, columns, "string").where("value IS NOT NULL")
    found = counted.groupBy(F.col("name").alias("column_name")).agg(
        F.count("*").alias("value_count"),
        F.count_if(F.col("n") > 1).alias("repeated_value_count"),
        F.sum(F.col("n") - 1).alias("excess_row_count"),
    )
    spark = next(iter(tables.values())).sparkSession
    listed = spark.createDataFrame([(f"{t}.{c}",) for t, c in columns], "column_name string")
    counts = [F.coalesce(name, zero).alias(name) for name in ("value_count", "repeated_value_count", "excess_row_count")]
    return F.broadcast(listed).join(found, "column_name", "left").select("column_name", *counts)


def null_report(tables: Mapping[str, DataFrame], columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Per required column, named table.column: the rows that hold NULL. Each table is read once."""
    parts = []
    for table, names in _named(tables, columns).items():
        counts = tables[table].agg(*[F.count_if(F.col(name).isNull()).alias(f"{table}.{name}") for name in names])
        parts.append(counts.unpivot([], [f"`{table}.{name}`" for name in names], "column_name", "null_count"))
    return reduce(DataFrame.unionByName, parts)


def outside_domain(table: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values a restricted column must not hold, with their number of rows."""
    return (
        table.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("row_count"))
    )


def newest(table: DataFrame, count: int, key: str = "id") -> DataFrame:
    return table.orderBy(F.col(key).desc()).limit(count)


def users_with_addresses(users: DataFrame, addresses: DataFrame, count: int | None = None) -> DataFrame:
    """All (user, address) pairs, or the first ``count`` by user and address id.

    No user can contribute more than ``count`` pairs, so each user's addresses are cut
    to the first ``count`` before they are joined.
    """
    if count is None:
        pairs = addresses.select("user_id", F.col("id").alias("address_id"))
        return pairs.join(users.select(F.col("id").alias("user_id")), "user_id", "left_semi")
    first = Window.partitionBy("user_id").orderBy("id")
    pairs = (
        addresses.select("user_id", "id")
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= count)
        .select("user_id", F.col("id").alias("address_id"))
    )
    return (
        pairs.join(users.select(F.col("id").alias("user_id")), "user_id", "left_semi")
        .orderBy("user_id", "address_id")
        .limit(count)
    )


def leaf_categories(categories: DataFrame) -> DataFrame:
    return categories.where(F.col("category_id").isNotNull())


def root_categories(categories: DataFrame) -> DataFrame:
    return categories.where(F.col("category_id").isNull())


def category_tree(categories: DataFrame, deepest: int = 100) -> DataFrame:
    """Categories of any depth: (id, category_name, root_id, depth, path, is_leaf, state).

    A recursive query walks down from the roots, a level a round. A category without children is a leaf.
    ``state`` is "root" or "child", "orphan" if the parent does not exist (it then counts as a
    root), or "cycle" for rows on or below a circle of parents, which no root leads to; these have no root, depth or path.
    A tree deeper than ``deepest`` is an error.
    """
    spark = categories.sparkSession
    rows = categories.select("id", "category_name", F.col("category_id").alias("parent_id"))
    parents = rows.select(F.col("parent_id").alias("id")).where("id IS NOT NULL").distinct().withColumn("has_children", F.lit(True))
    known = rows.select(F.col("id").alias("parent_id"), F.lit(True).alias("has_parent"))
    rows = rows.join(parents, "id", "left").join(known, "parent_id", "left")
    state = F.when(F.col("parent_id").isNull(), "root").when(F.col("has_parent"), "child").otherwise("orphan")
    rows = rows.select("id", "category_name", "parent_id", state.alias("state"), F.col("has_children").isNull().alias("is_leaf"))
    walked = spark.sql(
        f"""
        WITH RECURSIVE tree(id, root_id, depth, path) MAX RECURSION LEVEL {deepest} AS (
            SELECT id, id, 0, category_name FROM {{rows}} WHERE state <> 'child'
            UNION ALL
            SELECT c.id, t.root_id, t.depth + 1, concat(t.path, ' > ', c.category_name)
            FROM tree t JOIN {{rows}} c ON c.parent_id = t.id AND c.state = 'child'
        ) SELECT * FROM tree
        """,
        rows=rows,
    )
    found = rows.join(walked, "id", "left")
    state = F.when(F.col("depth").isNull(), "cycle").otherwise(F.col("state"))
    return found.select("id", "category_name", "root_id", "depth", "path", "is_leaf", state.alias("state"))
