"""Which product cost was in force when an order line was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdcmart.operators.skew import spread_lookup_join


def unit_cost_asof(
    lines: DataFrame,
    versions: DataFrame,
    *,
    line_id: str = "id",
    product: str = "product_id",
    line_time: str = "created_at",
    version_time: str = "valid_from",
    name: str = "unit_cost_at_order",
) -> DataFrame:
    """Lines plus the unit cost of the newest product version at or before their time.

    ``versions`` has the product, ``valid_from``, ``_version``, ``unit_cost`` and
    ``_deleted``; a deleted product and a product not yet known give NULL. Times are
    whole seconds.

    The answer depends only on (product, second), so each distinct pair is resolved
    once, however many lines share it. Pairs are resolved per product and day (at most
    86,400 seconds, whatever the number of lines), after the newest version of the
    days before has been carried in (one row per day). No line meets more than one
    version.
    """
    points = lines.select(F.col(product).alias("p"), F.col(line_time).alias("t")).dropna()
    changes = versions.select(
        F.col(product).alias("p"),
        F.col(version_time).alias("t"),
        F.col("_version").alias("v"),
        F.when(F.col("_deleted") == 0, F.col("unit_cost")).alias("cost"),
    )
    newest = [F.max("v").alias("v"), F.max_by("cost", "v").alias("cost")]
    # Used twice below. The filter is what the join on (p, d) implies anyway; written
    # here, both uses have the same plan and share one shuffle.
    seconds = (
        points.unionByName(changes, allowMissingColumns=True)
        .withColumn("d", F.to_date("t"))
        .where(F.col("p").isNotNull() & F.col("d").isNotNull())
        .groupBy("p", "d", "t")
        .agg(*newest)
    )
    earlier_days = Window.partitionBy("p").orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        seconds.groupBy("p", "d")
        .agg(*newest)
        .select(
            "p",
            "d",
            F.max("v").over(earlier_days).alias("v0"),
            F.max_by("cost", "v").over(earlier_days).alias("cost0"),
        )
    )
    so_far = Window.partitionBy("p", "d").orderBy("t")
    resolved = (
        seconds.withColumn("cost", F.max_by("cost", "v").over(so_far))
        .withColumn("v", F.max("v").over(so_far))
        .join(days, ["p", "d"])
        .select(
            "p",
            "t",
            F.when(F.col("v").isNull() | (F.col("v0") > F.col("v")), F.col("cost0"))
            .otherwise(F.col("cost"))
            .alias("unit_cost"),
        )
    )
    return spread_lookup_join(lines, resolved, {product: "p", line_time: "t"}, {name: "unit_cost"}, [line_id])
