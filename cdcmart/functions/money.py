"""Exact decimal arithmetic for money.

Spark divides decimals by rounding to the result scale. Rounding that quotient
again to cents can push a value just below a half cent up by a whole cent
(0.01 * 4999999999.99 / 10000000000.00 must be 0.00). The helpers below round
once, by checking the candidate against the undivided product.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(15,2)"  # stored money columns
MONEY = "decimal(18,2)"  # derived per-line money; 18 digits still fit a machine word
TOTAL = "decimal(28,2)"  # sums of money
COUNT = "decimal(13,0)"  # divisors made from counts: 13 digits keep the check exact


def _sign(amount: Column) -> Column:
    return F.when(amount < 0, F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)")


def _one_less_if(above: Column, candidate: Column, step: Column) -> Column:
    return candidate - F.when(above, step).otherwise(step - step)


def exact_ratio_round(a: Column, b: Column, c: Column) -> Column:
    """``a * b / c`` rounded half away from zero to cents; NULL unless ``c > 0``.

    ``a`` and ``b`` may be up to decimal(18,2) and ``c`` up to decimal(15,2). The shared
    parts stand outside every branch, so generated code computes them once.
    """
    product = a * b
    size, divisor = F.abs(product), F.when(c > 0, c)
    candidate = F.round(size / divisor, 2).cast(MONEY)
    cent, half = F.lit("0.01").cast("decimal(3,2)"), F.lit("0.005").cast("decimal(4,3)")
    rounded = _one_less_if((candidate - half) * divisor > size, candidate, cent)
    return (rounded * _sign(product)).cast(MONEY)


def exact_ratio_truncate(amount: Column, count: Column, scale: int) -> Column:
    """``amount / count`` cut off (toward zero) after ``scale`` digits; NULL unless ``count > 0``."""
    size, divisor = F.abs(amount.cast(TOTAL)), F.when(count > 0, count.cast(COUNT))
    kind = f"decimal({16 + scale},{scale})"
    candidate = (size / divisor).cast(kind)
    step = F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({scale + 1},{scale})")
    cut = _one_less_if(candidate * divisor > size, candidate, step)
    return (cut * _sign(amount)).cast(kind)


def percent_of(amount: Column, percent: Column) -> Column:
    """``percent`` per cent of ``amount``, half up to cents. Exact: no division involved."""
    hundredth = F.lit("0.01").cast("decimal(3,2)")
    return F.round(amount * percent * hundredth, 2).cast(MONEY)
