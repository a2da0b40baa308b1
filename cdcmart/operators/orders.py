"""Order economics and lifecycle as set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.money import AMOUNT, MONEY, percent_of
from cdcmart.operators.skew import lookup_join, spread_lookup_join

# VAT rate in per cent.
VAT_PERCENT = 10

# Current order status -> (next order status, shipping status).
NEXT_STEP = {
    "pending": ("confirmed", "pending"),
    "confirmed": ("shipping", "picked_up"),
    "shipping": ("delivered", "delivered"),
}
CASH_ON_DELIVERY = "COD"

# Texts written with the order number.
PAID_TEXT = "Payment for order #%s"
UNPAID_TEXT = "Payment pending for order #%s"
CASH_TEXT = "COD payment received for order #%s"
CREATED_TEXT = "Order #%s created"
MOVED_TEXT = "Order #%s moved to %s"


def price_lines(lines: DataFrame) -> DataFrame:
    """Add ``product_tax`` (half up to cents) and ``subtotal_amount`` (tax included)."""
    price = F.col("product_price").cast(AMOUNT)
    tax = percent_of(price, F.lit(VAT_PERCENT)).cast(AMOUNT)
    subtotal = ((price + F.col("product_tax")) * F.col("quantity")).cast(MONEY)
    return lines.withColumn("product_tax", tax).withColumn("subtotal_amount", subtotal)


def price_orders(
    headers: DataFrame, priced_lines: DataFrame, discounts: DataFrame, *, order_id: str = "order_id"
) -> DataFrame:
    """Headers plus order, discount and total amount and the number of lines.

    A percent discount is rounded half up; a fixed discount never exceeds the order. Any
    other discount type is an error. Validity dates of discounts are not looked at.
    """
    sums = priced_lines.groupBy(order_id).agg(
        F.sum("subtotal_amount").cast(MONEY).alias("order_amount"), F.count("*").alias("line_count")
    )
    priced = headers.join(sums, order_id, "left")
    priced = spread_lookup_join(
        priced,
        discounts,
        {"discount_id": "id"},
        {"_type": "type", "_value": "value"},
        [order_id],
        keys_from=headers,
    )
    order_amount = F.coalesce(F.col("order_amount"), F.lit(0).cast(MONEY))
    unknown = F.raise_error(F.concat(F.lit("unsupported discount type: "), F.col("_type"))).cast(MONEY)
    discount = (
        F.when(F.col("_type").isNull(), F.lit(0).cast(MONEY))
        .when(F.col("_type") == "percent", percent_of(F.col("order_amount"), F.col("_value")))
        .when(F.col("_type") == "amount", F.least(F.col("_value").cast(MONEY), F.col("order_amount")))
        .otherwise(unknown)
    )
    return (
        priced.withColumn("order_amount", order_amount)
        .withColumn("line_count", F.coalesce("line_count", F.lit(0)))
        .withColumn("discount_amount", discount)
        .withColumn("total_amount", (F.col("order_amount") - F.col("discount_amount")).cast(MONEY))
        .drop("_type", "_value")
    )


def _filled(text: str, *values: Column) -> Column:
    """``text`` with its gaps filled by column values."""
    return F.format_string(text, *[value.cast("string") for value in values])


def order_bundle(
    priced_orders: DataFrame,
    priced_lines: DataFrame,
    payment_methods: DataFrame,
    payment_status: DataFrame,
    order_status: DataFrame,
    shipping_status: DataFrame,
) -> dict[str, DataFrame]:
    """A new order's header, lines, payment and first history row, derived together.

    Cash on delivery starts with payment pending, every other method with payment
    completed. Headers without a line and lines without a header are no orders: they come
    back as ``rejected_orders`` and ``rejected_lines`` and stop nothing. Most frames come from
    ``priced_orders``: checkpoint it before, and write the frames with
    ``sources.log.publish`` so that readers see all of them or none.
    """
    rejected = priced_orders.where(F.col("line_count") <= 0)
    priced_orders = priced_orders.where(F.col("line_count") > 0)
    orders = lookup_join(
        priced_orders, payment_methods, {"payment_method_id": "id"}, {"_method": "payment_method_name"}
    )
    paid = F.coalesce(F.trim("_method") != CASH_ON_DELIVERY, F.lit(True))
    orders = (
        orders.withColumn("_paid", paid)
        .withColumn("_start", F.lit("pending"))
        .withColumn("_payment", F.when(F.col("_paid"), "completed").otherwise("pending"))
    )
    start, payment = ["pending"], ["pending", "completed"]
    orders = _with_id(orders, order_status, "order_status_name", start, "_start", "order_status_id")
    orders = _with_id(orders, shipping_status, "shipping_status_name", start, "_start", "shipping_status_id")
    orders = _with_id(orders, payment_status, "payment_status_name", payment, "_payment", "payment_status_id")
    order_id = F.col("order_id")
    payment_text = F.when(F.col("_paid"), _filled(PAID_TEXT, order_id)).otherwise(_filled(UNPAID_TEXT, order_id))
    return {
        "orders": orders.drop("_method", "_paid", "_start", "_payment"),
        "orderdetails": priced_lines.join(priced_orders.select("order_id"), "order_id", "left_semi"),
        "rejected_orders": rejected,
        "rejected_lines": priced_lines.join(priced_orders.select("order_id"), "order_id", "left_anti"),
        "transactions": orders.select(
            "order_id",
            F.lit("payment").alias("transaction_type"),
            F.col("_paid").cast("int").alias("status"),
            payment_text.alias("description"),
        ),
        "order_status_history": orders.select(
            "order_id", "order_status_id", _filled(CREATED_TEXT, order_id).alias("comments")
        ),
    }


def advance_orders(
    orders: DataFrame,
    order_status: DataFrame,
    payment_methods: DataFrame,
    payment_status: DataFrame,
    shipping_status: DataFrame,
    transactions: DataFrame,
    now: Column,
    limit: int | None = None,
) -> dict[str, DataFrame]:
    """Move all open orders, or the ``limit`` oldest, one step on.

    Returns the changed orders, the history rows they cause and the payments completed
    by delivering a cash order. The pick is by order id, so all three see the same
    orders.
    """
    open_status = order_status.select("id", F.trim("order_status_name").alias("name")).where(
        F.col("name").isin(*NEXT_STEP)
    )
    picked = lookup_join(orders, open_status, {"order_status_id": "id"}, {"_status": "name"}, "inner")
    picked = lookup_join(
        picked, payment_methods, {"payment_method_id": "id"}, {"_method": "payment_method_name"}, "inner"
    )
    if limit is not None:
        picked = picked.orderBy("id").limit(limit)

    def following(position: int) -> Column:
        step = F.lit(None).cast("string")
        for status, targets in NEXT_STEP.items():
            step = F.when(F.col("_status") == status, targets[position]).otherwise(step)
        return step

    picked = picked.withColumn("_next", following(0)).withColumn("_shipping", following(1))
    picked = picked.withColumn("_cash", (F.trim("_method") == CASH_ON_DELIVERY) & (F.col("_next") == "delivered"))
    picked = picked.withColumn("_done", F.lit("completed"))
    next_names = [target for target, _ in NEXT_STEP.values()]
    shipping_names = [target for _, target in NEXT_STEP.values()]
    moved = _with_id(picked, order_status, "order_status_name", next_names, "_next", "_next_id")
    moved = _with_id(moved, shipping_status, "shipping_status_name", shipping_names, "_shipping", "_shipping_id")
    moved = _with_id(moved, payment_status, "payment_status_name", ["completed"], "_done", "_done_id")
    updated = (
        moved.withColumn("order_status_id", F.col("_next_id"))
        .withColumn("shipping_status_id", F.col("_shipping_id"))
        .withColumn(
            "payment_status_id", F.when(F.col("_cash"), F.col("_done_id")).otherwise(F.col("payment_status_id"))
        )
        .withColumn("shipped_at", F.when(F.col("_next") == "shipping", now).otherwise(F.col("shipped_at")))
        .withColumn("updated_at", now)
        .select(*orders.columns)
    )
    history = moved.select(
        F.col("id").alias("order_id"),
        F.col("_next_id").alias("order_status_id"),
        _filled(MOVED_TEXT, F.col("id"), F.col("_next")).alias("comments"),
    )
    cash = moved.where("_cash").select(F.col("id").alias("order_id"))
    payments = (
        transactions.where(F.col("transaction_type") == "payment")
        .join(cash, "order_id", "left_semi")
        .withColumn("status", F.lit(1))
        .withColumn("description", _filled(CASH_TEXT, F.col("order_id")))
    )
    return {"orders": updated, "order_status_history": history, "transactions": payments}


def _with_id(
    rows: DataFrame, table: DataFrame, name_column: str, names: list[str], name: str, target: str
) -> DataFrame:
    """Add the id of a named status. Only the given names are looked up, so the
    broadcast holds at most that many rows, however large the table."""
    ids = (
        table.select(F.trim(name_column).alias("_n"), "id")
        .where(F.col("_n").isin(*names))
        .groupBy("_n")
        .agg(F.max("id").alias(target))
    )
    return rows.join(F.broadcast(ids), F.col(name) == F.col("_n"), "left").drop("_n")
