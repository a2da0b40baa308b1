"""Reading values off the wire.

A payload is JSON text. Spark's JSON reader stops after the first value, so
``{"a":1} x`` would pass as valid. The text is therefore wrapped into an array whose
second element carries a digest of the text: only if the text is exactly one JSON value
does that digest come out in second place. The same single pass yields the fields.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark's reader is more lenient than JSON unless told otherwise.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
MARK = "__digest"


def json_valid(payload: Column) -> Column:
    """Whether the text is exactly one JSON value of any kind."""
    wrapped = F.concat(F.lit("["), payload, F.lit(',"'), F.md5(payload), F.lit('"]'))
    return F.coalesce(F.get(F.from_json(wrapped, "array<string>", STRICT), F.lit(1)) == F.md5(payload), F.lit(False))


def open_as(log: DataFrame, element: str, column: str = "payload") -> DataFrame:
    """Add ``_json``: ``column`` read as ``element`` if it is one complete JSON object.
    ``element`` is a map, or a struct that has the field ``MARK``.

    Parse and check sit in one-element explodes because Spark moves filters below
    projections by copying the projected expressions into the filter; a filter on
    several fields would parse once per field. It is not moved below an explode.
    """
    digested = log.withColumn("_digest", F.md5(column))
    end = F.concat(F.lit(f',{{"{MARK}":"'), F.col("_digest"), F.lit('"}]'))
    pair = F.from_json(F.concat(F.lit("["), F.col(column), end), f"array<{element}>", STRICT)
    opened = digested.select("*", F.explode(F.array(pair)).alias("_pair"))
    complete = F.get("_pair", F.lit(1))[MARK].cast("string") == F.col("_digest")
    checked = opened.select("*", F.explode(F.array(F.when(complete, F.get("_pair", F.lit(0))))).alias("_json"))
    return checked.drop("_pair", "_digest")


def open_fields(log: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add ``_json``, a struct of the named fields as text (NULL when absent or null);
    the struct itself is NULL if the payload is not one JSON object."""
    return open_as(log, "struct<" + ", ".join(f"`{name}` string" for name in (*names, MARK)) + ">")


def open_object(log: DataFrame) -> DataFrame:
    """Add ``_json``, a map of all fields as text; a field holding null is present."""
    return open_as(log, "map<string,string>")


def decimal_or_null(text: Column) -> Column:
    return text.try_cast("decimal(15,2)")


def decimal_or_zero(text: Column) -> Column:
    return F.coalesce(decimal_or_null(text), F.lit(0).cast("decimal(15,2)"))


def float_or_null(text: Column) -> Column:
    return text.try_cast("double")


def whole(text: Column, kind: str) -> Column:
    """A whole number; JSON booleans count as 1 and 0."""
    return F.when(F.lower(text) == "true", 1).when(F.lower(text) == "false", 0).otherwise(text.try_cast(kind)).cast(kind)
