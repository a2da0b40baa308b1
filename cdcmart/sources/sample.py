"""The star-schema sample tables seen as change tables of the shop.

Every table is derived by Spark from whole sample tables; nothing is made up. The
mapping is one row per key (version 0, nothing deleted), so ``tables`` count as
compacted. ``histories`` tells the same rows as change tables: every row is created with
other values, corrected and delivered twice, and one in ten has a neighbour that was
deleted. ``event_log`` and ``order_log`` give raw change logs with several versions, deletes and defects.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions.money import AMOUNT, MONEY, percent_of
from cdcmart.functions.text import slug
from cdcmart.sources.specs import BY_ORDER, TOPIC_PREFIX

# Declared, so that no job has to look into the files before a query starts.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Names given to the sample's coded statuses and methods.
STATUS = {"F": (4, "delivered"), "O": (3, "shipping"), "P": (1, "pending")}
PAYMENT = {1: "COD", 2: "Credit Card", 3: "Momo", 4: "ZaloPay", 5: "Bank Transfer"}
SHIPPING = {1: "Standard", 2: "Express", 3: "Same Day"}


def _choose(key: Column, values: dict, position: int | None = None) -> Column:
    result = F.lit(None)
    for code, value in values.items():
        result = F.when(key == code, value if position is None else value[position]).otherwise(result)
    return result


def text_id(text: Column) -> Column:
    """A stable 60-bit id of a text."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


class Sample:
    """``Sample(spark, folder)[table]`` is a function returning the change table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def tables(self) -> dict[str, Callable[[], DataFrame]]:
        names = (
            "users", "regions", "provinces", "addresses", "categories", "brands", "products", "order_status",
            "payment_status", "shipping_status", "payment_methods", "shipping_methods", "ads_campaigns",
            "discounts", "orders", "orderdetails", "transactions", "roles", "role_user", "tags", "product_tag",
            "order_status_history",
        )
        return {name: partial(self._table, name) for name in names}

    def histories(self) -> dict[str, Callable[[], DataFrame]]:
        return {name: partial(self.history, name) for name in self.tables()}

    def history(self, name: str) -> DataFrame:
        """The table as changes of several versions whose current state are the table's rows."""
        final = self._table(name)
        keys = BY_ORDER.get(name, ("id",))
        numbers = [f.name for f in final.schema if isinstance(f.dataType, T.NumericType) and f.name[0] != "_" and f.name not in keys]

        def told(kind: str, version: int, deleted: int = 0) -> Column:
            return F.struct(F.lit(kind).alias("kind"), F.lit(version).cast("bigint").alias("version"), F.lit(deleted).alias("deleted"))

        newest = told("newest", 2)
        events = F.array(told("first", 1), newest, newest)
        gone = F.array(told("gone", 0), told("gone", 3, 1))
        # One pass over the mapped rows: every row tells all its versions.
        events = F.when(F.pmod(F.xxhash64("id"), F.lit(10)) == 0, F.concat(events, gone)).otherwise(events)
        kind, rows = F.col("_event.kind"), final.withColumn("_event", F.explode(events))
        # At first amounts and counts were one less, references were missing.
        first = {c: None if c.endswith("_id") else F.col(c) - 1 for c in numbers}
        changed = {c: F.when(kind != "first", F.col(c)) if value is None else F.when(kind == "first", value).otherwise(F.col(c)) for c, value in first.items()}
        changed = {c: value.cast(final.schema[c].dataType) for c, value in changed.items()}
        changed |= {
            "id": F.when(kind == "gone", -F.col("id") - 1).otherwise(F.col("id")),
            "_version": F.col("_event.version"),
            "_deleted": F.col("_event.deleted"),
        }
        return rows.withColumns(changed).select(*final.columns)

    def _table(self, name: str) -> DataFrame:
        return getattr(self, name)().withColumns({"_version": F.lit(0).cast("bigint"), "_deleted": F.lit(0)})

    # geography and people

    def regions(self) -> DataFrame:
        return self.read("region").select(F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("region_name"))

    def provinces(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.concat(F.col("n_name"), F.lit(" ")).alias("province_name"),
            F.col("n_regionkey").cast("bigint").alias("region_id"),
            F.timestamp_seconds(F.lit(0)).alias("created_at"),
        )

    def users(self) -> DataFrame:
        """Customers; the registration time is that of their first order."""
        first = self.read("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
        joined = self.read("customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
        return joined.select(
            F.col("c_custkey").alias("id"),
            F.concat(F.lit(" "), F.col("c_name")).alias("username"),
            F.coalesce(F.col("first_order").cast("timestamp"), F.timestamp_seconds(F.lit(0))).alias("created_at"),
        )

    def addresses(self) -> DataFrame:
        nation = self.read("nation").select("n_nationkey", "n_regionkey")
        return (
            self.read("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("id"),
                F.col("c_custkey").alias("user_id"),
                F.col("c_nationkey").cast("bigint").alias("province_id"),
                F.col("n_regionkey").cast("bigint").alias("region_id"),
            )
        )

    # catalog

    def brands(self) -> DataFrame:
        return (
            self.read("part")
            .select("p_brand")
            .distinct()
            .select(self._brand_id().alias("id"), F.col("p_brand").alias("brand_name"))
        )

    @staticmethod
    def _brand_id() -> Column:
        return F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("bigint")

    @staticmethod
    def _sub_name() -> Column:
        return F.concat(F.col("p_type"), F.lit(" & Co, size "), F.col("p_size").cast("string"))

    def categories(self) -> DataFrame:
        """Two levels: the part type, and the type with the size."""
        part = self.read("part")
        roots = part.select("p_type").distinct().select(
            text_id(F.col("p_type")).alias("id"),
            F.col("p_type").alias("category_name"),
            F.lit(None).cast("bigint").alias("category_id"),
        )
        leaves = part.select("p_type", "p_size").distinct().select(
            text_id(self._sub_name()).alias("id"),
            self._sub_name().alias("category_name"),
            text_id(F.col("p_type")).alias("category_id"),
        )
        return roots.unionByName(leaves).withColumn("slug", slug(F.col("category_name")))

    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast(AMOUNT)
        return self.read("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("product_name"),
            text_id(self._sub_name()).alias("category_id"),
            self._brand_id().alias("brand_id"),
            price.alias("product_price"),
            percent_of(price, F.lit(60)).cast(AMOUNT).alias("unit_cost"),
            F.timestamp_seconds(F.lit(0)).alias("created_at"),
        )

    # lookups

    def order_status(self) -> DataFrame:
        code = F.col("o_orderstatus")
        return (
            self.read("orders")
            .groupBy("o_orderstatus")
            .agg(F.min("o_orderdate").cast("timestamp").alias("created_at"))
            .select(
                _choose(code, STATUS, 0).cast("bigint").alias("id"),
                F.concat(_choose(code, STATUS, 1), F.lit(" ")).alias("order_status_name"),
                "created_at",
            )
        )

    def _all_statuses(self, names: tuple[str, ...], column: str) -> DataFrame:
        """Status tables the sample has no column for: named rows, present if there are orders."""
        listed = F.posexplode(F.array(*[F.lit(name) for name in names])).alias("pos", column)
        return (
            self.read("orders").agg(F.count("*").alias("n")).where("n > 0").select(listed)
            .select((F.col("pos") + 1).cast("bigint").alias("id"), column)
        )

    def payment_status(self) -> DataFrame:
        return self._all_statuses(("pending", "completed", "failed", "refunded"), "payment_status_name")

    def shipping_status(self) -> DataFrame:
        names = ("pending", "picked_up", "in_transit", "delivered", "returned")
        return self._all_statuses(names, "shipping_status_name")

    def lifecycle_status(self) -> DataFrame:
        return self._all_statuses(
            ("pending", "confirmed", "shipping", "delivered", "cancelled"), "order_status_name"
        )

    @staticmethod
    def _priority() -> Column:
        return F.substring("o_orderpriority", 1, 1).cast("bigint")

    @staticmethod
    def _campaign() -> Column:
        return F.when(Sample._priority() < 5, Sample._priority())

    @staticmethod
    def _shipping() -> Column:
        return F.pmod(F.col("o_orderkey"), F.lit(3)) + 1

    def _codes(self, code: Column) -> DataFrame:
        return self.read("orders").select(code.cast("bigint").alias("id")).distinct().where("id is not null")

    def payment_methods(self) -> DataFrame:
        return self._codes(self._priority()).withColumn("payment_method_name", _choose(F.col("id"), PAYMENT))

    def shipping_methods(self) -> DataFrame:
        return self._codes(self._shipping()).withColumn("shipping_method_name", _choose(F.col("id"), SHIPPING))

    def ads_campaigns(self) -> DataFrame:
        title = F.concat(F.lit("Campaign "), F.col("id").cast("string"))
        return self._codes(self._campaign()).withColumn("campaign_title", title)

    def discounts(self) -> DataFrame:
        """One per campaign; percent for odd ids, a fixed amount for even ones."""
        odd = F.pmod(F.col("id"), F.lit(2)) == 1
        return self._codes(self._campaign()).select(
            "id",
            F.col("id").alias("adscampaign_id"),
            F.when(odd, "percent").otherwise("amount").alias("type"),
            F.when(odd, F.col("id") * 5).otherwise(F.col("id") * 500000).cast(AMOUNT).alias("value"),
        )

    # orders

    def lines(self) -> DataFrame:
        """Priced lines: the line's price before tax, its tax, its tax-included subtotal.

        The line id packs line number, part and price into one number: unique within an
        order (the sample's line numbers alone are not) and in that order.
        """
        number = (F.col("l_linenumber").cast("bigint") * (1 << 36) + F.col("l_partkey")) * (1 << 24)
        price = F.col("product_price")
        return (
            self.read("lineitem")
            .select(
                "l_orderkey",
                "l_partkey",
                "l_linenumber",
                "l_shipdate",
                F.col("l_quantity").cast("int").alias("quantity"),
                F.col("l_extendedprice").cast(AMOUNT).alias("product_price"),
                F.col("l_tax").cast("decimal(4,2)").alias("tax_rate"),
                F.col("l_discount").cast("decimal(4,2)").alias("discount_rate"),
            )
            .withColumn("product_tax", F.round(price * F.col("tax_rate"), 2).cast(AMOUNT))
            .select(
                (number + (price * 100).cast("bigint")).alias("id"),
                F.col("l_orderkey").alias("order_id"),
                F.col("l_partkey").alias("product_id"),
                "quantity",
                "product_price",
                "product_tax",
                ((price + F.col("product_tax")) * F.col("quantity")).cast(AMOUNT).alias("subtotal_amount"),
                F.when(F.col("l_linenumber") != 7, percent_of(price, F.lit(60)).cast(AMOUNT)).alias("unit_cost_at_order"),
                "discount_rate",
                F.col("l_shipdate").cast("timestamp").alias("created_at"),
            )
        )

    def orderdetails(self) -> DataFrame:
        return self.lines().drop("discount_rate")

    def orders(self) -> DataFrame:
        sums = (
            self.lines()
            .groupBy("order_id")
            .agg(
                F.sum("subtotal_amount").cast(AMOUNT).alias("amount"),
                F.sum(F.col("subtotal_amount") * F.col("discount_rate")).alias("discount"),
            )
        )
        zero = F.lit(0).cast(AMOUNT)
        order_amount = F.coalesce("amount", zero)
        discount = F.coalesce(F.round("discount", 2).cast(AMOUNT), zero)
        placed = F.col("o_orderdate").cast("timestamp")
        return (
            self.read("orders")
            .join(sums, F.col("o_orderkey") == F.col("order_id"), "left")
            .select(
                F.col("o_orderkey").alias("id"),
                F.col("o_custkey").alias("user_id"),
                F.lit(None).cast("bigint").alias("staff_id"),
                F.col("o_custkey").alias("address_id"),
                order_amount.alias("order_amount"),
                discount.alias("discount_amount"),
                (order_amount - discount).cast(AMOUNT).alias("total_amount"),
                self._campaign().alias("discount_id"),
                self._priority().alias("payment_method_id"),
                F.lit(1).cast("bigint").alias("payment_status_id"),
                _choose(F.col("o_orderstatus"), STATUS, 0).cast("bigint").alias("order_status_id"),
                self._shipping().alias("shipping_method_id"),
                F.lit(1).cast("bigint").alias("shipping_status_id"),
                F.lit(None).cast("timestamp").alias("shipped_at"),
                placed.alias("created_at"),
                placed.alias("updated_at"),
            )
        )

    def transactions(self) -> DataFrame:
        """One payment per order; cash orders (method 1) are unpaid."""
        paid = (self._priority() != 1).cast("int")
        return self.read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderkey").alias("order_id"),
            F.lit("payment").alias("transaction_type"),
            paid.alias("status"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
            F.concat(F.lit("Payment for order #"), F.col("o_orderkey").cast("string")).alias("description"),
        )

    def order_status_history(self) -> DataFrame:
        """The creation of each order."""
        return self.read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderkey").alias("order_id"),
            F.lit(1).cast("bigint").alias("order_status_id"),
            F.lit(None).cast("bigint").alias("staff_id"),
            F.concat(F.lit("Order #"), F.col("o_orderkey").cast("string"), F.lit(" created")).alias("comments"),
            F.col("o_orderdate").cast("timestamp").alias("created_at"),
        )

    # roles and tags

    def roles(self) -> DataFrame:
        """Market segments as roles."""
        segments = self.read("customer").select("c_mktsegment").distinct()
        return segments.select(
            text_id(F.col("c_mktsegment")).alias("id"),
            F.col("c_mktsegment").alias("role_name"),
            F.lower("c_mktsegment").alias("role_title"),
        )

    def role_user(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_custkey").alias("user_id"),
            text_id(F.col("c_mktsegment")).alias("role_id"),
        )

    def tags(self) -> DataFrame:
        """Part sizes as tags."""
        sizes = self.read("part").select(F.col("p_size").cast("bigint").alias("id")).distinct()
        return sizes.select("id", F.concat(F.lit("size "), F.col("id").cast("string")).alias("tag_name"))

    def product_tag(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_partkey").alias("product_id"),
            F.col("p_size").cast("bigint").alias("tag_id"),
        )

    # change logs

    def event_changes(self) -> DataFrame:
        """Events as changes of a user: newest event wins, an error event deletes."""
        return self.read("events").select(
            F.col("user_id").alias("id"),
            "event_type",
            F.col("value").cast(MONEY).alias("value"),
            F.date_trunc("second", F.col("ts").cast("timestamp")).alias("created_at"),
            F.col("event_id").alias("_version"),
            (F.col("event_type") == "error").cast("int").alias("_deleted"),
        )

    def event_log(self) -> DataFrame:
        """Events as raw log records of the line table, one defect class per residue of
        the event id: broken text, missing or wrong envelope fields, unusable values."""
        def text(*parts: str | Column) -> Column:
            return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

        event = F.col("event_id")
        cents = F.round(F.col("value") * 100).cast("bigint")
        rest = F.pmod(F.col("cents"), F.lit(100))
        whole = ((F.col("cents") - rest) / 100).cast("bigint")
        pieces = (
            self.read("events")
            .select("*", F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"), cents.alias("cents"))
            .select("*", text(whole, ".", F.lpad(rest.cast("string"), 2, "0")).alias("price"))
            .select(
                "event_id",
                "event_type",
                "ts",
                F.pmod(event, F.lit(14)).alias("residue"),
                text(
                    '"id":', event, ',"order_id":', F.col("user_id"), ',"product_id":7,"quantity":',
                    F.pmod(event, F.lit(5)) + 1, ',"created_at":', F.col("millis"),
                ).alias("body"),
                text(
                    ',"product_price":"', F.col("price"), '","unit_cost_at_order":"', F.col("price"), '"'
                ).alias("money"),
                text(
                    ',"__op":"', F.when(F.col("event_type") == "error", "d").otherwise("c"),
                    '","__table":"orderdetails","__source_ts_ms":', F.col("millis"),
                ).alias("envelope"),
            )
        )
        body, money, envelope = F.col("body"), F.col("money"), F.col("envelope")
        variants = {
            1: text("{bad ", event),
            2: text("{", body, "}"),
            3: text("{", body, ',"__op":"x","__table":"orderdetails","__source_ts_ms":1}'),
            4: text("{", body, ',"__op":null}'),
            5: text("{", body, ',"__op":"u"}'),
            6: text("{", body, ',"__op":"u","__table":"orderdetails"}'),
            7: text("{", body, money, envelope, "} tail"),
            8: event.cast("string"),
            9: text("{", body, ',"product_price":"abc","unit_cost_at_order":"abc"', envelope, "}"),
            10: text("{", body, ',"product_price":null,"unit_cost_at_order":null', envelope, "}"),
            11: text('{"id":"n/a",', '"quantity":1', money, envelope, "}"),
        }
        payload = text("{", body, money, envelope, "}")
        for number, variant in variants.items():
            payload = F.when(F.col("residue") == number, variant).otherwise(payload)
        return pieces.select(
            text(f"{TOPIC_PREFIX}.", F.col("event_type")).alias("topic"),
            F.lit(0).alias("partition"),
            event.alias("offset"),
            payload.alias("payload"),
            F.col("ts").cast("timestamp").alias("ts"),
        )

    def order_log(self) -> DataFrame:
        """Orders as a change log: created pending, then brought to the final state; the
        second version of an order is delivered a second time under the same version."""
        final = self._table("orders").withColumn("_version", F.col("id") * 4 + 1)
        created = final.withColumn("_version", F.col("id") * 4).withColumn("order_status_id", F.lit(1).cast("bigint"))
        return created.unionByName(final).unionByName(final)

    def product_versions(self) -> DataFrame:
        """Product costs over time: a sale event sets the cost of the product numbered like
        the user, an error event removes the product."""
        return self.read("events").select(
            F.col("user_id").alias("product_id"),
            F.date_trunc("second", F.col("ts").cast("timestamp")).alias("valid_from"),
            F.col("event_id").alias("_version"),
            F.col("value").cast(AMOUNT).alias("unit_cost"),
            (F.col("event_type") == "error").cast("int").alias("_deleted"),
        )
