"""The paths taken on large data give the same rows as the plain ones."""

import pytest
from conftest import SAMPLE_FOLDER, rows
from pyspark.sql import functions as F

from checks.compare import connect, differences
from cdcmart.operators import skew
from cdcmart.plans import gold

JOINING = [
    "silver_orders", "silver_products", "silver_locations", "sales_line_base", "sales_line_preliminary",
    "sales_line_allocated", "sales_line_measured", "fact_sales_product", "discount_conservation",
    "report_marketing_dashboard", "report_overview_orders", "report_delivered_order_aov", "price_orders",
    "unit_cost_asof", "resolve_parent_key", "advance_orders", "order_headers",
]


@pytest.fixture(scope="module")
def connection():
    return connect(SAMPLE_FOLDER)


@pytest.mark.parametrize("name", JOINING)
def test_query_on_crowded_keys(spark, connection, crowded, name):
    assert differences(spark, connection, SAMPLE_FOLDER, name) is None


def _skewed(spark):
    """A third of 3000 rows on key 1, a third without key, the rest spread."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(1)).when(n % 3 == 1, F.col("id") % 700).cast("bigint")
    return spark.range(3000).select("id", key.alias("key"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_plain_join(spark, crowded, how):
    fact = _skewed(spark)
    table = spark.range(0, 500).select("id", (F.col("id") * 10).alias("value"))
    expected = fact.join(table.select(F.col("id").alias("k"), "value"), F.col("key") == F.col("k"), how)
    actual = skew.spread_lookup_join(fact, table, {"key": "id"}, {"value": "value"}, ["id"], how)
    assert rows(actual) == rows(expected.select("id", "key", "value"))


def test_lookup_join_spreads_the_hot_key(spark, crowded):
    """After the join no task holds much more than its share."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = spark.range(0, 500).select("id", F.lit(1).alias("value"))
        joined = skew.spread_lookup_join(_skewed(spark), table, {"key": "id"}, {"value": "value"}, ["id"])
        sizes = [row[0] for row in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 3000 and len(sizes) == 4
    assert max(sizes) < 1100


def test_hot_keys_are_bounded_and_repeatable(spark, monkeypatch):
    monkeypatch.setattr(skew, "SAMPLE", 4)
    monkeypatch.setattr(skew, "SEEN", 20)
    fact = _skewed(spark)
    first = rows(skew.hot_keys(fact, ["key"], ["id"]))
    assert first == [(1,)] == rows(skew.hot_keys(fact.repartition(7), ["key"], ["id"]))
    monkeypatch.setattr(skew, "SEEN", 1)
    monkeypatch.setattr(skew, "HOT_KEYS", 3)
    assert skew.hot_keys(fact, ["key"], ["id"]).count() == 3


def test_rank_descending(spark):
    frame = spark.range(1, 2001).select((F.col("id") % 3).alias("g"), (F.col("id") * 37).alias("n"))
    ranked = skew.rank_descending(frame, "g", "n", "rank", bits=5)
    expected = frame.selectExpr("g", "n", "cast(row_number() over (partition by g order by n desc) as bigint) as rank")
    assert rows(ranked) == rows(expected)


def test_one_order_with_a_third_of_all_lines(spark, crowded):
    n = F.col("id")
    lines = spark.range(3000).select(
        F.when(n % 3 == 0, 1).otherwise(n).cast("bigint").alias("order_id"),
        n.alias("order_item_id"),
        (n % 10).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(100).cast("decimal(18,2)").alias("gmv"),
        F.lit(110).cast("decimal(15,2)").alias("subtotal_amount"),
        F.lit(None).cast("decimal(15,2)").alias("unit_cost_at_order"),
    )
    heads = lines.groupBy("order_id").agg(F.sum("subtotal_amount").cast("decimal(15,2)").alias("order_amount"))
    heads = heads.selectExpr(
        "order_id", "timestamp'2024-01-01 00:00:00' as created_at", "date'2024-01-01' as date_key", "0L as city_id",
        "0L as campaign_key", "order_amount", "cast(0.37 as decimal(15,2)) as discount_amount",
    )
    split = rows(gold.sales_line_measured(heads, lines))
    skew.SEEN = 1 << 40
    plain = rows(gold.sales_line_measured(heads, lines))
    assert split == plain and len(split) == 3000
