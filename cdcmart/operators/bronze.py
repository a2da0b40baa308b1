"""Payload text to typed change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.functions import wire
from cdcmart.functions.time import millis_to_second
from cdcmart.sources.specs import TableSpec


def _value(text: Column, kind: str) -> Column:
    match kind:
        case "id":
            return F.coalesce(wire.whole(text, "bigint"), F.lit(0).cast("bigint"))
        case "id?":
            return wire.whole(text, "bigint")
        case "int":
            return F.coalesce(wire.whole(text, "int"), F.lit(0))
        case "str":
            return F.coalesce(text, F.lit(""))
        case "str?":
            return text
        case "money":
            return wire.decimal_or_zero(text)
        case "money?":
            return wire.decimal_or_null(text)
        case "float?":
            return wire.float_or_null(text)
        case "time":
            return millis_to_second(F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint")))
        case "time?":
            return millis_to_second(text.try_cast("bigint"))
        case "flag+":
            return F.coalesce(wire.whole(text, "int"), F.lit(1))
    raise ValueError(f"unknown column kind {kind}")


def unreadable(texts: Column, spec: TableSpec) -> Column:
    """Whether a present field (``texts``: struct or map of all fields as text) cannot be
    held by its declared wire type. Money and floats travel as text and fall back to a
    default, so they never make a row unreadable."""
    found = F.lit(False)
    for name, kind in spec.fields:
        text = texts[name]
        if kind in ("id", "id?", "time", "time?"):
            value = wire.whole(text, "bigint") if kind.startswith("id") else text.try_cast("bigint")
        elif kind in ("int", "flag+"):
            value = wire.whole(text, "int")
        else:
            continue
        found = found | (text.isNotNull() & value.isNull())
    return found


def typed_with_status(
    log: DataFrame, spec: TableSpec, version: str = "offset", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Typed change rows plus ``_broken`` (not one JSON object, or a field of the wrong
    type). Unknown fields are ignored. ``keep`` passes columns of the log through."""
    source = log.select(F.col(version).alias("_version"), "payload", *keep)
    fields = wire.open_fields(source, ["__op", "__source_ts_ms", *[name for name, _ in spec.fields]])
    texts = F.col("_json")
    return fields.select(
        *[_value(texts[name], kind).alias(name) for name, kind in spec.fields],
        "_version",
        F.coalesce(texts["__op"] == "d", F.lit(False)).cast("int").alias("_deleted"),
        (texts.isNull() | unreadable(texts, spec)).alias("_broken"),
        texts["__source_ts_ms"].try_cast("bigint").alias("_source_ts_ms"),
        *keep,
    )


def typed_bronze(
    log: DataFrame, spec: TableSpec, version: str = "offset", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The readable changes of one table: typed columns, ``_version``, ``_deleted``.

    Offsets order a topic of one partition. For more, keep ``_source_ts_ms`` and
    ``partition`` and order by (``_source_ts_ms``, ``partition``, ``_version``).
    """
    names = [name for name, _ in spec.fields]
    readable = typed_with_status(log, spec, version, tuple(name for name in keep if name != "_source_ts_ms"))
    return readable.where(~F.col("_broken")).select(*names, "_version", "_deleted", *keep)
