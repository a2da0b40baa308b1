"""Exact rounding against Python's decimal arithmetic."""

from decimal import ROUND_DOWN, ROUND_HALF_UP, Context, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdcmart.functions.money import exact_ratio_round, exact_ratio_truncate, percent_of
from cdcmart.functions.text import slug

WIDE = Context(prec=100)
cents = st.integers(-(10**13), 10**13)
positive = st.integers(1, 10**13)


def money(value: int) -> Decimal:
    return Decimal(value).scaleb(-2)


def divided(top: Decimal, bottom: Decimal, digits: str, rounding: str) -> Decimal:
    return WIDE.divide(top, bottom).quantize(Decimal(digits), rounding=rounding, context=WIDE)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(cents, positive, positive), min_size=300, max_size=300))
def test_ratio_round(spark, triples):
    # a * b / c with b <= c, as in a share of an order
    triples = [(a, min(b, c), max(b, c)) for a, b, c in triples]
    frame = spark.createDataFrame(
        [tuple(map(money, t)) for t in triples], "a decimal(15,2), b decimal(18,2), c decimal(15,2)"
    )
    got = [r[0] for r in frame.select(exact_ratio_round(F.col("a"), F.col("b"), F.col("c"))).collect()]
    want = [divided(WIDE.multiply(money(a), money(b)), money(c), "0.01", ROUND_HALF_UP) for a, b, c in triples]
    assert got == want


def test_just_below_and_exactly_half_a_cent(spark):
    frame = spark.createDataFrame(
        [(money(1), money(499999999999), money(1000000000000)), (money(1), money(500000000000), money(1000000000000)),
         (money(-1), money(500000000000), money(1000000000000)), (money(1), money(1), money(0))],
        "a decimal(15,2), b decimal(18,2), c decimal(15,2)",
    )
    got = [r[0] for r in frame.select(exact_ratio_round(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [Decimal("0.00"), Decimal("0.01"), Decimal("-0.01"), None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**9)), min_size=300, max_size=300))
def test_ratio_truncate(spark, pairs):
    frame = spark.createDataFrame([(money(a), n) for a, n in pairs], "a decimal(28,2), n bigint")
    got = [r[0] for r in frame.select(exact_ratio_truncate(F.col("a"), F.col("n"), 8)).collect()]
    assert got == [divided(money(a), Decimal(n), "0.00000001", ROUND_DOWN) for a, n in pairs]


def test_percent(spark):
    frame = spark.createDataFrame([(money(9995), money(1000)), (money(32985), money(1500))], "a decimal(15,2), p decimal(15,2)")
    assert [r[0] for r in frame.select(percent_of(F.col("a"), F.col("p"))).collect()] == [money(1000), money(4948)]


def test_slug(spark):
    frame = spark.createDataFrame([("Home & Garden, Tools",)], "name string")
    assert frame.select(slug(F.col("name"))).first()[0] == "home-and-garden-tools"
