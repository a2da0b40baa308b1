from conftest import rows
from pyspark.sql import functions as F

from cdcmart.operators.distinct import count_sets, distinct_sets, merge_sets


def test_counts_over_any_grouping_equal_count_distinct(spark):
    told = spark.range(4000).select(
        (F.col("id") % 7).alias("product"), F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("day"), F.expr("(id * 7919) % 90001 - 40000").alias("order_id")
    )
    told = told.unionByName(told).unionByName(told.limit(3).withColumn("order_id", F.lit(None).cast("bigint")))
    for sparse in (0, 3, 1024):
        sets = distinct_sets(told, ["product", "day"], "order_id", sparse)
        for keys in (["product"], ["day"], ["product", "day"], []):
            want = told.groupBy(*keys).agg(F.count_distinct("order_id").alias("n"))
            assert rows(count_sets(sets, keys, "n")) == rows(want)
    # Merged sets are merged again.
    by_day = merge_sets(sets, ["day"])
    assert rows(count_sets(by_day, [], "n")) == rows(told.agg(F.count_distinct("order_id").alias("n")))


def test_lists_and_bitmaps(spark):
    told = spark.range(1, 40_001).select(F.when(F.col("id") < 6, "few").otherwise("many").alias("k"), "id")
    sets = {(r.k, r.bucket): r for r in distinct_sets(told, ["k"], "id", 10).collect()}
    assert [r.bits is None for r in sets.values() if r.k == "few"] == [True]
    assert all(len(r.bits) == 4096 and r.positions is None for r in sets.values() if r.k == "many")
    assert distinct_sets(told.limit(0), ["k"], "id").count() == 0
