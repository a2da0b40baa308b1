"""Dimensions and facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdcmart.functions.money import AMOUNT, MONEY, TOTAL, exact_ratio_round
from cdcmart.functions.time import business_date, in_business_days
from cdcmart.operators.skew import fits_broadcast, hinted, hot_keys, lookup_join, rank_descending, spread_lookup_join

# The calendar runs from 2000-01-01 to 2099-12-31.
CALENDAR_START = "2000-01-01"
CALENDAR_DAYS = 36525

SOLD = "delivered"


def dim_date(spark: SparkSession) -> DataFrame:
    """ISO weekdays: Monday is 1, Sunday 7; the weekend is 6 and 7."""
    day = F.date_add(F.lit(CALENDAR_START).cast("date"), F.col("id").cast("int"))
    weekday = F.weekday("date_key") + 1
    return spark.range(CALENDAR_DAYS).select(day.alias("date_key")).select(
        "date_key",
        F.dayofmonth("date_key").alias("day"),
        F.month("date_key").alias("month"),
        F.quarter("date_key").alias("quarter"),
        F.year("date_key").alias("year"),
        weekday.alias("day_of_week"),
        weekday.isin(6, 7).cast("int").alias("is_weekend"),
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_name",
        "brand_name",
        "category_name",
        "subcategory_name",
        "unit_cost",
        "current_price",
        "updated_at",
    )


def dim_locations(locations: DataFrame) -> DataFrame:
    return locations.select("province_id", "province_name", "region_id", "region_name", "updated_at")


def dim_campaigns(campaigns: DataFrame) -> DataFrame:
    return campaigns.select("campaign_id", "campaign_title", "updated_at")


def dim_order_status(order_status: DataFrame) -> DataFrame:
    return order_status.select("id", "name", "updated_at")


def fact_user_registration(users: DataFrame) -> DataFrame:
    return users.groupBy("registration_date").agg(F.count("*").alias("user_amount"))


def between_days(orders: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """Orders of the given business days; the bounds reach the scan as a time range."""
    return orders.where(in_business_days(F.col("created_at"), first, last))


def fact_order_overview(orders: DataFrame) -> DataFrame:
    """Each current order counts in exactly one bucket. ``total_gmv`` is the amount
    payable: tax included, discount taken off."""
    return orders.groupBy(
        business_date(F.col("created_at")).alias("date_key"),
        "city_id",
        "order_status_id",
        "payment_method",
        "shipping_method",
    ).agg(F.count("*").alias("order_count"), F.sum("total_amount").cast(TOTAL).alias("total_gmv"))


# --- sale lines -----------------------------------------------------------------------

ORDER_COLUMNS = ("order_id", "created_at", "date_key", "city_id", "campaign_key", "order_amount", "discount_amount")
LINE_COLUMNS = ("order_item_id", "product_id", "quantity", "gmv", "subtotal_amount", "unit_cost_at_order")


def only_delivered(orders: DataFrame, order_status: DataFrame) -> DataFrame:
    """Orders whose status is named 'delivered' in any case; unknown status is excluded.

    Works on change-table orders as well as on cleaned ones, so that undelivered orders
    can be dropped before anything is looked up for them.
    """
    sold = order_status.where(F.lower("name") == SOLD)
    return lookup_join(orders, sold, {"order_status_id": "id"}, {}, "inner")


def sale_heads(orders: DataFrame) -> DataFrame:
    """The attributes of delivered orders that their lines inherit."""
    return orders.withColumn("date_key", business_date(F.col("created_at"))).select(*ORDER_COLUMNS)


def sales_line_base(heads: DataFrame, order_items: DataFrame, keys_from: DataFrame | None = None) -> DataFrame:
    """Lines of delivered orders with the order's attributes. Hot orders are looked for in ``keys_from``
    (default: the lines themselves), also in the steps below."""
    attributes = {name: name for name in ORDER_COLUMNS if name != "order_id"}
    lines = order_items.select("order_id", *LINE_COLUMNS)
    joined = spread_lookup_join(lines, heads, {"order_id": "order_id"}, attributes, ["order_item_id"], "inner", keys_from)
    return joined.select(*ORDER_COLUMNS, *LINE_COLUMNS)


def _share() -> Column:
    """A line's part of the order discount by its part of the order amount."""
    ratio = exact_ratio_round(F.col("discount_amount"), F.col("subtotal_amount"), F.col("order_amount"))
    return F.coalesce(ratio, F.lit(0).cast(MONEY))


def _by_window(heads: DataFrame, lines: DataFrame, ranked: bool) -> DataFrame:
    """Ordinary orders: the join hashes and sorts both sides by order, and the windows
    reuse it. A merge join is asked for because a broadcast of the lines would leave all
    the moving to the windows. Few orders (a short range of days) are broadcast instead:
    then only their lines move.

    The date is a function of the order. Naming it in the window's partition lets a
    filter on the date pass below the window.
    """
    order = Window.partitionBy("order_id", "date_key")
    heads = hinted(heads) if fits_broadcast(heads) else heads.hint("merge")
    shares = heads.join(lines, "order_id").withColumn("preliminary_discount", _share())
    rank = F.row_number().over(order.orderBy(F.col("order_item_id").desc())).cast("bigint")
    return shares.select(
        "*",
        *[rank.alias("reverse_line_number")] * ranked,
        F.sum("preliminary_discount").over(order).cast(TOTAL).alias("preliminary_total"),
        F.max("order_item_id").over(order).alias("last_item_id"),
    )


def _by_totals(heads: DataFrame, lines: DataFrame, ranked: bool) -> DataFrame:
    """Orders with very many lines: their lines stay where they are.

    The order rows come to them by broadcast (hot orders are few), totals are
    summed within each task first, and the totals, one row per order, are broadcast back.
    """
    shares = lines.join(F.broadcast(heads), "order_id").withColumn("preliminary_discount", _share())
    totals = shares.groupBy("order_id").agg(
        F.sum("preliminary_discount").cast(TOTAL).alias("preliminary_total"),
        F.max("order_item_id").alias("last_item_id"),
    )
    if ranked:
        shares = rank_descending(shares, "order_id", "order_item_id", "reverse_line_number")
    return shares.join(F.broadcast(totals), "order_id")


#: From the hot orders and the kind of join with them to heads and order items: "left_semi" gives both of the
#: hot orders, "left_anti" all heads and the items of the others.
Split = Callable[[DataFrame, str], tuple[DataFrame, DataFrame]]


def _shares(heads: DataFrame, order_items: DataFrame, ranked: bool, keys_from: DataFrame | None, split: Split | None) -> DataFrame:
    # By the line's own id alone: the sample is then taken before the newest versions are picked.
    hot = hot_keys(order_items if keys_from is None else keys_from, ["order_id"], ["order_item_id"])

    def part(how: str) -> tuple[DataFrame, DataFrame]:
        if split:
            some, items = split(hot, how)
        else:
            some = heads.join(F.broadcast(hot), "order_id", how) if how == "left_semi" else heads
            items = order_items.join(F.broadcast(hot), "order_id", how)
        return some, items.select("order_id", *LINE_COLUMNS)

    ordinary = _by_window(*part("left_anti"), ranked)
    crowded = _by_totals(*part("left_semi"), ranked)
    return ordinary.unionByName(crowded)


def sales_line_preliminary(
    heads: DataFrame, order_items: DataFrame, keys_from: DataFrame | None = None, split: Split | None = None
) -> DataFrame:
    """Discount share per line, its rank from the last line, and the order's sum of shares.

    ``split`` divides heads and items by hot orders, where that can be done before their newest versions are picked.
    """
    return _shares(heads, order_items, True, keys_from, split).select(
        *ORDER_COLUMNS, *LINE_COLUMNS, "preliminary_discount", "reverse_line_number", "preliminary_total"
    )


def sales_line_allocated(
    heads: DataFrame, order_items: DataFrame, *, ranked: bool = True, keys_from: DataFrame | None = None, split: Split | None = None
) -> DataFrame:
    """The last line (largest id) takes what rounding left over, cents may go negative.

    ``ranked=False`` leaves the line rank out; the facts do not need it.
    """
    remainder = F.col("preliminary_discount") + F.col("discount_amount") - F.col("preliminary_total")
    gross = F.when(F.col("order_item_id") == F.col("last_item_id"), remainder).otherwise(
        F.col("preliminary_discount")
    )
    return _shares(heads, order_items, ranked, keys_from, split).select(
        *ORDER_COLUMNS,
        *LINE_COLUMNS,
        "preliminary_discount",
        *["reverse_line_number"] * ranked,
        "preliminary_total",
        gross.cast(MONEY).alias("discount_gross"),
    )


def sales_line_measured(
    heads: DataFrame, order_items: DataFrame, *, ranked: bool = True, keys_from: DataFrame | None = None, split: Split | None = None
) -> DataFrame:
    """The discount without tax: gross discount times the line's untaxed share."""
    ratio = exact_ratio_round(F.col("discount_gross"), F.col("gmv"), F.col("subtotal_amount").cast(AMOUNT))
    return sales_line_allocated(heads, order_items, ranked=ranked, keys_from=keys_from, split=split).withColumn(
        "discount_ex_vat",
        F.coalesce(ratio, F.lit(0).cast(MONEY)),
    )


SALES_KEYS = ("date_key", "city_id", "product_id", "campaign_key")


def sales_sums(measured: DataFrame, *more: str) -> DataFrame:
    """The additive measures of sale lines by day, city, product, campaign (and ``more``)."""
    known = F.sum((F.col("quantity") * F.col("unit_cost_at_order")).cast(MONEY)).cast(TOTAL)
    return measured.groupBy(*SALES_KEYS, *more).agg(
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.sum("gmv").cast(TOTAL).alias("gmv"),
        F.coalesce(known, F.lit(0).cast(TOTAL)).alias("known_cost"),
        F.count_if(F.col("unit_cost_at_order").isNull()).alias("unknown_cost_line_count"),
        F.sum("discount_gross").cast(TOTAL).alias("discount_gross"),
        F.sum("discount_ex_vat").cast(TOTAL).alias("discount_val"),
        *[F.count_distinct("order_id").alias("order_count")] * (not more),
    )


def finish_sales(sums: DataFrame) -> DataFrame:
    """The sales fact from its sums."""
    return sums.select(
        *SALES_KEYS,
        "quantity",
        "gmv",
        F.when(F.col("unknown_cost_line_count") == 0, F.col("known_cost")).alias("total_cost"),
        "unknown_cost_line_count",
        "discount_gross",
        "discount_val",
        (F.col("gmv") - F.col("discount_val")).cast(TOTAL).alias("net_revenue"),
        "order_count",
    )


def fact_sales_product(measured: DataFrame) -> DataFrame:
    """Delivered sales by day, city, product and campaign.

    ``total_cost`` is NULL as soon as one line's cost is unknown. ``order_count`` is
    distinct within its row and must not be added up over products.
    """
    return finish_sales(sales_sums(measured))


def discount_conservation(allocated: DataFrame) -> DataFrame:
    """One row: orders, orders whose line discounts do not add up to the order's."""
    per_order = allocated.groupBy("order_id").agg(
        F.sum("discount_gross").cast(TOTAL).alias("given"), F.max("discount_amount").alias("agreed")
    )
    return per_order.agg(
        F.count("*").alias("order_count"),
        F.count_if(F.col("given") != F.col("agreed")).alias("violation_count"),
        F.sum("given").cast(TOTAL).alias("discount_total"),
    )
