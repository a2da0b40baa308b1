"""Facts that are kept up to date by the changes alone.

The additive facts are sums over orders (or users). A change retracts what its old row
added and adds its new row: only the orders that a batch affects are computed, once from the tables before the
batch and once from those after it, and the difference is merged into the stored sums. Tables
and facts lie in bucketed stores (``sources.base``), so a batch reads and writes the buckets that it
touches and no others.

A batch has a number. Its tables are merged first, then the facts; each step is committed
by that number, and both states are read by version. So a batch that is applied again after a
failure goes on where it stopped and counts nothing twice.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.operators.state import STORED
from cdcmart.plans.gold import SALES_KEYS, finish_sales, sales_sums
from cdcmart.plans.warehouse import Warehouse
from cdcmart.session import delete, released
from cdcmart.sources.base import Store, added
from cdcmart.sources.specs import TABLES

#: Columns of an order that refer to looked-up rows: a change there affects all orders that refer to it.
REFERENCES = {
    "addresses": "address_id",
    "discounts": "discount_id",
    "payment_methods": "payment_method_id",
    "shipping_methods": "shipping_method_id",
    "order_status": "order_status_id",
}


class Fact(NamedTuple):
    """``sums`` per ``keys`` of what ``rows`` gives for some orders or users; ``count`` is 0 when nothing is left."""

    about: str
    tables: tuple[str, ...]
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    count: str
    rows: Callable[[Warehouse], DataFrame]


def _sales(warehouse: Warehouse) -> DataFrame:
    # Orders are retracted and added whole, so distinct orders may be counted by adding.
    per_order = sales_sums(warehouse.sales_line_measured(ranked=False), "order_id")
    sums = [F.sum(c).cast(per_order.schema[c].dataType).alias(c) for c in _SALES_SUMS if c != "order_count"]
    return per_order.groupBy(*SALES_KEYS).agg(*sums, F.count("*").alias("order_count"))


_SALES_SUMS = ("quantity", "gmv", "known_cost", "unknown_cost_line_count", "discount_gross", "discount_val", "order_count")
_OVERVIEW_KEYS = ("date_key", "city_id", "order_status_id", "payment_method", "shipping_method")

FACTS = {
    "fact_sales_product": Fact(
        "orders", ("orders", "orderdetails", "addresses", "discounts", "order_status"), SALES_KEYS, _SALES_SUMS, "order_count", _sales
    ),
    "fact_order_overview": Fact(
        "orders", ("orders", "addresses", "discounts", "payment_methods", "shipping_methods"), _OVERVIEW_KEYS,
        ("order_count", "total_gmv"), "order_count", Warehouse.fact_order_overview,
    ),
    "fact_user_registration": Fact("users", ("users",), ("registration_date",), ("user_amount",), "user_amount", Warehouse.fact_user_registration),
}


class MaintainedFacts:
    """Tables and facts at ``path``; ``names`` are the facts that are kept.

    Order lines are stored by their order and never move to another one.
    """

    def __init__(
        self, spark: SparkSession, path: str, names: Sequence[str] = tuple(FACTS), *, buckets: int, version: str | Sequence[str] = "_version"
    ):
        self.spark, self.path, self.version = spark, path, version
        self.kept = {name: FACTS[name] for name in names}
        used = dict.fromkeys(table for fact in self.kept.values() for table in fact.tables)
        self.tables = {
            table: Store(spark, f"{path}/tables/{table}", buckets=buckets, **({"keys": ("order_id", "id"), "by": ("order_id",)} if table == "orderdetails" else {}))
            for table in used
        }
        self.facts = {name: Store(spark, f"{path}/facts/{name}", buckets=buckets, keys=("key",)) for name in self.kept}

    def apply(self, changes: Mapping[str, DataFrame], batch_id: int) -> None:
        """Merge a batch of changes into the tables, then its effect into the facts.

        Every batch has a higher number than those before; tables without a fact are ignored.
        """
        with self._scratch() as copy:
            told = {table: rows for table, rows in changes.items() if table in self.tables}
            if any(store.exists(before=batch_id) for store in self.tables.values()):
                # Read several times below. A first load is not copied.
                told = {table: copy(rows) for table, rows in told.items()}
            for table, rows in told.items():
                self.tables[table].merge_changes(rows, batch_id, self.version)
            affected: dict[str, tuple[DataFrame, list[int]]] = {}
            for name, fact in self.kept.items():
                if batch_id in self.facts[name].versions():
                    continue
                if not self._has(fact.about, {"before": batch_id}):
                    after = fact.rows(self._state(fact, {"upto": batch_id}))
                    self._merge(name, fact, after.select(*fact.keys, *fact.sums), after, batch_id, copy)
                    continue
                if fact.about not in affected:
                    ids = copy(self._affected(fact.about, told, batch_id))
                    affected[fact.about] = ids, self.tables[fact.about].slots_of(ids)
                after = fact.rows(self._state(fact, {"upto": batch_id}, *affected[fact.about]))
                before = fact.rows(self._state(fact, {"before": batch_id}, *affected[fact.about]))
                retracted = before.select(*fact.keys, *[(-F.col(c)).alias(c) for c in fact.sums])
                # One state at a time: what is shuffled for the one is gone when the other is computed.
                parts = copy(after.select(*fact.keys, *fact.sums)).unionByName(copy(retracted))
                self._merge(name, fact, parts, after, batch_id, copy)

    @contextmanager
    def _scratch(self) -> Iterator[Callable[[DataFrame], DataFrame]]:
        """A function that writes rows beside the tables and reads them back; they go at the end."""
        folder = f"{self.path}/scratch-{uuid.uuid4().hex}"

        def copy(rows: DataFrame) -> DataFrame:
            path = f"{folder}/{uuid.uuid4().hex}"
            with released(self.spark):
                rows.write.option("compression", "zstd").parquet(path)
            return self.spark.read.schema(rows.schema).parquet(path)

        try:
            yield copy
        finally:
            delete(self.spark, folder)

    def _merge(self, name: str, fact: Fact, parts: DataFrame, like: DataFrame, batch_id: int, copy: Callable[[DataFrame], DataFrame]) -> None:
        kinds = {c: like.schema[c].dataType for c in fact.sums}
        # Keys may be null; their JSON text is not, and tells them apart.
        key = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in fact.keys])).alias("key")
        delta = parts.groupBy(*fact.keys).agg(*[F.sum(c).cast(kind).alias(c) for c, kind in kinds.items()])
        changed = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in fact.sums])
        delta = copy(delta.where(changed).select(key, *fact.keys, *fact.sums))
        self.facts[name].merge(delta, batch_id, added(fact.sums), F.col(fact.count) != 0)

    def _affected(self, about: str, told: Mapping[str, DataFrame], batch_id: int) -> DataFrame:
        """Ids whose rows may count otherwise after the batch."""
        found = [self.spark.createDataFrame([], "id bigint")]
        if about in told:
            found.append(told[about].select("id"))
        if about == "orders":
            if "orderdetails" in told:
                found.append(told["orderdetails"].select(F.col("order_id").alias("id")))
            for table, reference in REFERENCES.items():
                if table in told and table in self.tables:
                    # Orders whose own reference changed are affected anyhow, so the new references do.
                    ids = told[table].select(F.col("id").alias(reference)).distinct()
                    orders = self._rows("orders", {"upto": batch_id})
                    found.append(orders.join(ids, reference, "left_semi").select("id"))
        return reduce(DataFrame.unionByName, found).where("id IS NOT NULL").distinct()

    def _has(self, table: str, which: Mapping[str, int]) -> bool:
        return self.tables[table].exists(**which)

    def _rows(self, table: str, which: Mapping[str, int], slots: Sequence[int] | None = None) -> DataFrame:
        if self._has(table, which):
            return self.tables[table].read(slots=slots, **which)
        columns = [f"{name} {STORED[kind]}" for name, kind in TABLES[table].fields]
        return self.spark.createDataFrame([], ", ".join([*columns, "_version bigint", "_deleted int"]))

    def _state(
        self, fact: Fact, which: Mapping[str, int], ids: DataFrame | None = None, slots: Sequence[int] | None = None
    ) -> Warehouse:
        """The tables of one state; with ``ids`` only the affected orders or users, and of those the buckets ``slots``.

        Orders and their lines lie by the same number, so in buckets of the same numbers.
        """
        rows = {}
        for table in fact.tables:
            key = {fact.about: "id", "orderdetails": "order_id"}.get(table)
            if key is None or ids is None:
                rows[table] = self._rows(table, which)
            else:
                some = self._rows(table, which, slots)
                rows[table] = some.join(ids.withColumnRenamed("id", key), key, "left_semi").select(*some.columns)
        return Warehouse(self.spark, rows, compacted=rows)

    # reading

    def sums(self, name: str) -> DataFrame:
        return self.facts[name].read().drop("key")

    def fact_sales_product(self) -> DataFrame:
        return finish_sales(self.sums("fact_sales_product"))

    def fact_order_overview(self) -> DataFrame:
        return self.sums("fact_order_overview")

    def fact_user_registration(self) -> DataFrame:
        return self.sums("fact_user_registration")

    def drop_unreferenced(self, keep: int, before: dt.datetime) -> None:
        """Delete what none of the newest ``keep`` versions needs, as ``Store.drop_unreferenced``. A batch that
        failed half-way needs the version before it: apply it again first."""
        for store in (*self.tables.values(), *self.facts.values()):
            store.drop_unreferenced(keep, before)

    def discard(self) -> None:
        """Delete all that is stored: for tables of one run."""
        for store in (*self.tables.values(), *self.facts.values()):
            store.discard()

