"""Text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(name: Column) -> Column:
    """Lower case; spaces become hyphens, ``&`` becomes ``and``, commas vanish."""
    text = F.lower(name)
    for old, new in ((" ", "-"), ("&", "and"), (",", "")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def trimmed_or(name: Column, fallback: str) -> Column:
    return F.coalesce(F.trim(name), F.lit(fallback))
