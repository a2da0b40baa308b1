"""Reports.

A fact is aggregated by ids first and only then given names: ids are narrow to move,
and since every dimension holds an id once, adding names to finished rows equals
grouping by the names as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.money import TOTAL, exact_ratio_truncate
from cdcmart.operators.skew import lookup_join


def _dated(rows: DataFrame, dates: DataFrame, *parts: str) -> DataFrame:
    # The calendar has a fixed number of days, so it can always be broadcast.
    calendar = F.broadcast(dates.select(F.col("date_key").alias("_day"), *parts))
    return rows.join(calendar, F.col("date_key") == F.col("_day"), "left").drop("_day")


def marketing_dashboard(
    sales: DataFrame, dates: DataFrame, locations: DataFrame, products: DataFrame, campaigns: DataFrame
) -> DataFrame:
    """Campaign and product performance. The order count is per row and product."""
    named = _dated(sales, dates, "month", "quarter", "year")
    named = lookup_join(
        named, locations, {"city_id": "province_id"}, {"province": "province_name", "region": "region_name"}
    )
    named = lookup_join(
        named,
        products,
        {"product_id": "product_id"},
        {"parent_category": "category_name", "subcategory": "subcategory_name", "product_name": "product_name"},
    )
    named = lookup_join(named, campaigns, {"campaign_key": "campaign_id"}, {"campaign_title": "campaign_title"})
    per_order = exact_ratio_truncate(F.col("net_revenue"), F.col("order_count"), 8)
    per_item = exact_ratio_truncate(F.col("gmv"), F.col("quantity"), 4)
    return named.select(
        F.col("date_key").alias("date"),
        "month",
        "quarter",
        "year",
        F.col("city_id").alias("province_id"),
        "province",
        "region",
        "product_id",
        "parent_category",
        "subcategory",
        "product_name",
        F.col("campaign_key").alias("campaign_id"),
        "campaign_title",
        F.col("gmv").alias("total_gmv"),
        F.col("net_revenue").alias("total_net_revenue"),
        F.col("quantity").alias("quantity_sold"),
        F.col("order_count").alias("product_order_count"),
        per_order.alias("product_aov_ex_vat"),
        F.coalesce(per_item, F.lit(0).cast("decimal(20,4)")).alias("avg_product_price"),
    )


def overview_sales(sales: DataFrame, dates: DataFrame, locations: DataFrame, products: DataFrame) -> DataFrame:
    key = ["date_key", "city_id", "product_id"]
    totals = sales.groupBy(*key).agg(
        F.sum("gmv").cast(TOTAL).alias("total_gmv"),
        F.sum("net_revenue").cast(TOTAL).alias("total_net_revenue"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("order_count").alias("product_order_count"),
    )
    named = _dated(totals, dates, "month", "year")
    named = lookup_join(named, locations, {"city_id": "province_id"}, {"province": "province_name"})
    named = lookup_join(
        named, products, {"product_id": "product_id"}, {"product": "product_name", "category": "category_name"}
    )
    return named.select(
        F.col("date_key").alias("date"),
        "month",
        "year",
        F.col("city_id").alias("province_id"),
        "province",
        "product_id",
        "product",
        "category",
        "total_gmv",
        "total_net_revenue",
        "total_quantity_sold",
        "product_order_count",
    )


def overview_orders(
    overview: DataFrame, dates: DataFrame, locations: DataFrame, order_status: DataFrame
) -> DataFrame:
    named = _dated(overview, dates, "month")
    named = lookup_join(named, locations, {"city_id": "province_id"}, {"province": "province_name"})
    named = lookup_join(named, order_status, {"order_status_id": "id"}, {"order_status": "name"})
    return named.select(
        F.col("date_key").alias("date"),
        "month",
        F.col("city_id").alias("province_id"),
        "province",
        "order_status_id",
        "order_status",
        "payment_method",
        "shipping_method",
        "order_count",
        F.col("total_gmv").alias("order_revenue"),
    )


def overview_users(registrations: DataFrame) -> DataFrame:
    return registrations.select(
        "registration_date",
        F.month("registration_date").alias("month"),
        F.col("user_amount").alias("new_user_count"),
    )


def delivered_order_aov(measured: DataFrame) -> DataFrame:
    """Average order value per day and city: every order counts once, however many
    products it holds."""
    totals = measured.groupBy(F.col("date_key").alias("date"), "city_id").agg(
        F.count_distinct("order_id").alias("delivered_order_count"),
        F.sum("gmv").cast(TOTAL).alias("gmv_ex_vat"),
        F.sum(F.col("gmv") - F.col("discount_ex_vat")).cast(TOTAL).alias("net_sales_ex_vat"),
    )
    average = exact_ratio_truncate(F.col("net_sales_ex_vat"), F.col("delivered_order_count"), 8)
    return totals.withColumn("aov_ex_vat", average)


def fact_validation(sales: DataFrame) -> DataFrame:
    """One row proving that the fact can be computed end to end."""
    return sales.agg(F.count("*").alias("product_rows"), F.sum("gmv").cast(TOTAL).alias("gmv"))
