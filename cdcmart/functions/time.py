"""Instants, business dates and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_ZONE = "Asia/Ho_Chi_Minh"


def business_date(instant: Column) -> Column:
    """Local calendar date of a UTC instant (needs a UTC session time zone)."""
    return F.to_date(F.from_utc_timestamp(instant, BUSINESS_ZONE))


def millis_to_second(millis: Column) -> Column:
    """Epoch milliseconds to a timestamp cut to the whole second; NULL stays NULL."""
    return F.date_trunc("second", F.timestamp_millis(millis))


def in_business_days(instant: Column, first: dt.date | None, last: dt.date | None) -> Column:
    """Rows whose business date lies in [first, last], as a range on the raw instant.

    The bounds are literals, so the range reaches the Parquet scan and lets row
    groups be skipped, which a condition on the derived date could not.
    """
    keep = F.lit(True)
    if first is not None:
        keep = keep & (instant >= F.to_utc_timestamp(F.lit(first).cast("timestamp"), BUSINESS_ZONE))
    if last is not None:
        after = last + dt.timedelta(days=1)
        keep = keep & (instant < F.to_utc_timestamp(F.lit(after).cast("timestamp"), BUSINESS_ZONE))
    return keep


def month_key(instant: Column) -> Column:
    """Year and month as a number (yyyymm), the partition key of the append-only logs."""
    return F.year(instant) * 100 + F.month(instant)


def within_days(instant: Column, days: int, now: Column) -> Column:
    """Rows not older than ``days`` at ``now``."""
    return instant >= now - F.make_dt_interval(F.lit(days))
