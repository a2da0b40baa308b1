"""Cleaned entities. Inputs are current-state tables (one live row per id).

An unmatched optional reference gives 0 or 'Unknown' where the entity defines a
default, and NULL elsewhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.money import MONEY
from cdcmart.functions.text import trimmed_or
from cdcmart.functions.time import business_date
from cdcmart.operators.skew import lookup_join, spread_lookup_join


def _or_zero(name: str):
    return F.coalesce(F.col(name), F.lit(0).cast("bigint"))


def users(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("id").alias("user_id"),
        F.trim("username").alias("username"),
        business_date(F.col("created_at")).alias("registration_date"),
        "created_at",
        F.col("created_at").alias("updated_at"),
    )


def locations(provinces: DataFrame, regions: DataFrame) -> DataFrame:
    placed = lookup_join(
        provinces, regions, {"region_id": "id"}, {"_region": "id", "_region_name": "region_name"}
    )
    return placed.select(
        F.col("id").alias("province_id"),
        F.trim("province_name").alias("province_name"),
        F.col("_region").alias("region_id"),
        F.trim("_region_name").alias("region_name"),
        F.col("created_at").alias("updated_at"),
    )


def campaigns(ads_campaigns: DataFrame) -> DataFrame:
    """``updated_at`` is the time of reading; leave it out of comparisons."""
    return ads_campaigns.select(
        F.col("id").alias("campaign_id"),
        F.trim("campaign_title").alias("campaign_title"),
        F.current_timestamp().alias("updated_at"),
    )


def order_status(order_status: DataFrame) -> DataFrame:
    return order_status.select(
        "id", F.trim("order_status_name").alias("name"), F.col("created_at").alias("updated_at")
    )


def placed_orders(
    orders: DataFrame, addresses: DataFrame, discounts: DataFrame, keys_from: DataFrame | None = None
) -> DataFrame:
    """Orders with delivery city and campaign: all that the sales facts need. Hot references are
    looked for in ``keys_from`` (default: the orders)."""
    source = orders if keys_from is None else keys_from
    joined = spread_lookup_join(
        orders, addresses, {"address_id": "id"}, {"_province": "province_id"}, ["id"], keys_from=source
    )
    joined = spread_lookup_join(
        joined, discounts, {"discount_id": "id"}, {"_campaign": "adscampaign_id"}, ["id"], keys_from=source
    )
    return joined.withColumns(
        {
            "order_id": F.col("id"),
            "city_id": _or_zero("_province"),
            "campaign_key": _or_zero("_campaign"),
            "order_status_id": _or_zero("order_status_id"),
        }
    )


def orders(
    orders: DataFrame,
    addresses: DataFrame,
    discounts: DataFrame,
    payment_methods: DataFrame,
    shipping_methods: DataFrame,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    joined = placed_orders(orders, addresses, discounts, keys_from)
    joined = lookup_join(
        joined, payment_methods, {"payment_method_id": "id"}, {"_payment": "payment_method_name"}
    )
    joined = lookup_join(
        joined, shipping_methods, {"shipping_method_id": "id"}, {"_shipping": "shipping_method_name"}
    )
    return joined.select(
        "order_id",
        "user_id",
        "city_id",
        "campaign_key",
        "order_status_id",
        trimmed_or(F.col("_payment"), "Unknown").alias("payment_method"),
        trimmed_or(F.col("_shipping"), "Unknown").alias("shipping_method"),
        "total_amount",
        "order_amount",
        "discount_amount",
        "created_at",
        "updated_at",
    )


def products(products: DataFrame, brands: DataFrame, categories: DataFrame) -> DataFrame:
    """A product's category is the sub-category; the parent is one step up."""
    roots = categories.select("id", "category_name")
    tree = lookup_join(
        categories, roots, {"category_id": "id"}, {"_parent": "id", "_parent_name": "category_name"}
    )
    joined = lookup_join(products, brands, {"brand_id": "id"}, {"_brand": "brand_name"})
    joined = lookup_join(
        joined,
        tree,
        {"category_id": "id"},
        {"_sub": "id", "_sub_name": "category_name", "_parent": "_parent", "_parent_name": "_parent_name"},
    )
    return joined.select(
        F.col("id").alias("product_id"),
        F.trim("product_name").alias("product_name"),
        _or_zero("brand_id").alias("brand_id"),
        trimmed_or(F.col("_brand"), "Unknown").alias("brand_name"),
        _or_zero("_parent").alias("category_id"),
        trimmed_or(F.col("_parent_name"), "Unknown").alias("category_name"),
        _or_zero("_sub").alias("subcategory_id"),
        trimmed_or(F.col("_sub_name"), "Unknown").alias("subcategory_name"),
        "unit_cost",
        F.col("product_price").alias("current_price"),
        F.col("created_at").alias("updated_at"),
    )


def order_items(orderdetails: DataFrame) -> DataFrame:
    """A line is identified by its own id; an order may hold a product twice.
    ``gmv`` is quantity times price, before tax."""
    return orderdetails.select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "product_id",
        "quantity",
        F.col("product_price").alias("current_price"),
        "product_tax",
        "subtotal_amount",
        "unit_cost_at_order",
        (F.col("quantity") * F.col("product_price")).cast(MONEY).alias("gmv"),
        F.col("created_at").alias("updated_at"),
    )
