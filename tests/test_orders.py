"""Pricing, bundles, lifecycle, costs in force, keys and constraints."""

import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cdcmart.operators import orders, quality
from cdcmart.operators.asof import unit_cost_asof

LINE = "id bigint, order_id bigint, product_id bigint, quantity int, product_price decimal(15,2)"
STATUS = ("pending", "confirmed", "shipping", "delivered", "cancelled")
SHIPPING = ("pending", "picked_up", "in_transit", "delivered", "returned")


def named(spark, names, column):
    return spark.createDataFrame([(n, name) for n, name in enumerate(names, 1)], f"id bigint, {column} string")


@pytest.fixture
def lookups(spark):
    return {
        "order_status": named(spark, STATUS, "order_status_name"),
        "shipping_status": named(spark, SHIPPING, "shipping_status_name"),
        "payment_status": named(spark, ("pending", "completed", "failed", "refunded"), "payment_status_name"),
        "payment_methods": named(spark, ("COD", "Momo"), "payment_method_name"),
    }


def priced(spark, discount, method=1, lines=1):
    bought = [(n, 1, 1, 3, D("99.95")) for n in range(lines)]
    line = orders.price_lines(spark.createDataFrame(bought, LINE))
    header = spark.createDataFrame(
        [(1, None if discount is None else 1, method)], "order_id bigint, discount_id bigint, payment_method_id bigint"
    )
    discounts = spark.createDataFrame(
        [(1, *(discount or ("percent", "0")))], "id bigint, type string, value string"
    ).withColumn("value", F.col("value").cast("decimal(15,2)"))
    return orders.price_orders(header, line, discounts), line


def test_line_price(spark):
    _, line = priced(spark, None)
    assert tuple(line.first())[-2:] == (D("10.00"), D("329.85"))


@pytest.mark.parametrize(
    ("discount", "expected"),
    [(None, "0.00"), (("percent", "15"), "49.48"), (("amount", "50000"), "329.85"), (("amount", "20"), "20.00")],
)
def test_order_price(spark, discount, expected):
    order = priced(spark, discount)[0].first()
    assert (order.order_amount, order.discount_amount) == (D("329.85"), D(expected))
    assert order.total_amount == order.order_amount - order.discount_amount


def test_unknown_discount_type_is_an_error(spark):
    with pytest.raises(Exception, match="unsupported discount type: gift"):
        priced(spark, ("gift", "1"))[0].collect()


@pytest.mark.parametrize(("method", "status", "paid"), [(1, 1, 0), (2, 2, 1)])
def test_bundle(spark, lookups, method, status, paid):
    bundle = orders.order_bundle(*priced(spark, None, method), **{k: lookups[k] for k in sorted(lookups)})
    header = bundle["orders"].first()
    assert (header.order_status_id, header.shipping_status_id, header.payment_status_id) == (1, 1, status)
    text = "Payment for order #1" if paid else "Payment pending for order #1"
    assert rows(bundle["transactions"]) == [(1, "payment", paid, text)]
    assert rows(bundle["order_status_history"]) == [(1, 1, "Order #1 created")]


def test_headers_without_line_and_lines_without_header_are_rejected(spark, lookups):
    header, line = priced(spark, None)
    empty = header.withColumns({"order_id": F.lit(2).cast("bigint"), "line_count": F.lit(0).cast("bigint")})
    stray = line.withColumn("order_id", F.lit(3).cast("bigint"))
    bundle = orders.order_bundle(header.unionByName(empty), line.unionByName(stray), **lookups)
    assert [r.order_id for r in bundle["orders"].collect()] == [1]
    assert [r.order_id for r in bundle["orderdetails"].collect()] == [1]
    assert [r.order_id for r in bundle["transactions"].collect()] == [1]
    assert [r.order_id for r in bundle["rejected_orders"].collect()] == [2]
    assert [r.order_id for r in bundle["rejected_lines"].collect()] == [3]


def test_lifecycle(spark, lookups):
    now = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    # id, status, payment method: cash and card orders in every status
    book = [(number, status, method) for number, (status, method) in enumerate(((s, m) for s in range(1, 6) for m in (1, 2)), 1)]
    current = spark.createDataFrame(book, "id bigint, order_status_id bigint, payment_method_id bigint").selectExpr(
        "*", "1L as shipping_status_id", "1L as payment_status_id", "cast(null as timestamp) as shipped_at",
        "timestamp'2024-01-01' as updated_at",
    )
    payments = current.selectExpr("id", "id as order_id", "'payment' as transaction_type", "0 as status", "'' as description")
    payments = payments.union(payments.withColumn("transaction_type", F.lit("refund")))
    moved = orders.advance_orders(current, **lookups, transactions=payments, now=F.lit(now))
    steps = {r.id: r for r in moved["orders"].collect()}
    assert {n: (r.order_status_id, r.shipping_status_id) for n, r in steps.items()} == {
        1: (2, 1), 2: (2, 1), 3: (3, 2), 4: (3, 2), 5: (4, 4), 6: (4, 4),
    }
    assert {n for n, r in steps.items() if r.shipped_at is not None} == {3, 4}
    assert {n for n, r in steps.items() if r.payment_status_id == 2} == {5}
    assert rows(moved["transactions"]) == [(5, 5, "payment", 1, "COD payment received for order #5")]
    assert (1, 2, "Order #1 moved to confirmed") in rows(moved["order_status_history"])
    first = orders.advance_orders(current, **lookups, transactions=payments, now=F.lit(now), limit=2)
    assert [r.id for r in first["orders"].orderBy("id").collect()] == [1, 2]


def test_cost_in_force(spark):
    def at(hour, day=1):
        return dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)

    versions = spark.createDataFrame(
        [(1, at(8), 1, D("5.00"), 0), (1, at(10), 2, D("6.00"), 0), (1, at(10), 3, D("7.00"), 0),
         (1, at(9, 3), 4, None, 1), (1, at(1, 5), 5, D("9.00"), 0), (1, at(0, 5), 6, D("8.00"), 0)],
        "product_id bigint, valid_from timestamp, _version bigint, unit_cost decimal(15,2), _deleted int",
    )
    times = {
        1: at(7), 2: at(8), 3: at(9), 4: at(10), 5: at(12, 2), 6: at(8, 3), 7: at(9, 3), 8: at(1, 4), 9: at(0, 5),
        10: at(2, 5), 11: at(5, 9),
    }
    lines = spark.createDataFrame(
        [(n, 1, when) for n, when in times.items()] + [(12, 2, at(9)), (13, None, at(9))],
        "id bigint, product_id bigint, created_at timestamp",
    )
    found = {r.id: r.unit_cost_at_order for r in unit_cost_asof(lines, versions).collect()}
    # The largest version counts among those in force, also where times are out of order.
    assert {n: cost and str(cost) for n, cost in found.items()} == {
        1: None, 2: "5.00", 3: "5.00", 4: "7.00", 5: "7.00", 6: "7.00", 7: None, 8: None, 9: "8.00", 10: "8.00",
        11: "8.00", 12: None, 13: None,
    }


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a",), (None,)], "name string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None), (5, None)], "id int, name string")
    assert rows(quality.insert_if_absent(old, new, "name", "id")) == [(2, "b"), (4, None), (5, None)]


def test_without_related(spark):
    parents = spark.range(5).select("id")
    children = spark.createDataFrame([(1,), (1,), (3,), (None,)], "user_id bigint")
    assert rows(quality.without_related(parents, children, "user_id")) == [(0,), (2,), (4,)]


def test_resolve_parent(spark):
    parents = spark.createDataFrame([(1, "x"), (4, "x"), (2, "y")], "id bigint, name string")
    children = spark.createDataFrame([(1, "x"), (2, "z"), (3, "y"), (4, None)], "id bigint, parent string")
    found = quality.resolve_parent(children, parents, "parent", "name", "parent_id", "id")
    assert rows(found) == [(1, "x", 4), (3, "y", 2)]


def test_reports_find_violations(spark):
    tables = {
        "brands": spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id bigint, brand_name string"),
        "products": spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "id bigint, brand_id bigint"),
    }
    foreign = quality.foreign_key_report(tables, [("products", "brand_id", "brands")])
    assert rows(foreign) == [("products.brand_id", "brands", 4, 1, 2)]
    with pytest.raises(ValueError, match="orders.user_id"):
        quality.foreign_key_report(tables, [("products", "brand_id", "brands"), ("orders", "user_id", "users")])
    with pytest.raises(ValueError, match="users.email"):
        quality.unique_report(tables, [("brands", "brand_name"), ("users", "email")])
    unique = quality.unique_report(tables, [("brands", "brand_name")])
    assert rows(unique) == [("brands.brand_name", 1, 1, 1)]
    nulls = quality.null_report(tables, [("brands", "id"), ("brands", "brand_name"), ("products", "brand_id")])
    assert rows(nulls) == [("brands.brand_name", 2), ("brands.id", 0), ("products.brand_id", 1)]
    with pytest.raises(ValueError, match="brands.color"):
        quality.null_report(tables, [("brands", "color")])
    assert rows(quality.outside_domain(tables["brands"], "brand_name", ("b",))) == [("a", 2), (None, 2)]


def test_first_pairs_of_users_and_addresses(spark):
    users = spark.range(1, 4).select("id")
    addresses = spark.createDataFrame([(9, 2), (7, 2), (8, 2), (1, 5), (2, 3)], "id bigint, user_id bigint")
    assert rows(quality.users_with_addresses(users, addresses, 3)) == [(2, 7), (2, 8), (2, 9)]
    assert rows(quality.newest(users, 2)) == [(2,), (3,)]


def test_category_tree_of_any_depth(spark):
    from cdcmart.operators.quality import category_tree

    told = [(1, "a", None), (2, "b", 1), (3, "c", 2), (4, "d", 3), (5, "e", None), (6, "f", 99), (7, "g", 6), (8, "h", 9), (9, "i", 8), (10, "j", 9)]
    found = {r.id: r for r in category_tree(spark.createDataFrame(told, "id bigint, category_name string, category_id bigint")).collect()}
    assert (found[4].root_id, found[4].depth, found[4].path, found[4].is_leaf) == (1, 3, "a > b > c > d", True)
    assert [found[i].state for i in range(1, 11)] == ["root", "child", "child", "child", "root", "orphan", "child", "cycle", "cycle", "cycle"]
    assert found[7].path == "f > g" and found[8].root_id is None and found[10].is_leaf and not found[1].is_leaf
