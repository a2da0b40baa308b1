"""Malformed events: a copy for inspection, beside (not instead of) the typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.wire import json_valid, open_object
from cdcmart.operators.bronze import unreadable
from cdcmart.sources.specs import OPERATIONS, TABLES


def reason(payload: Column, fields: Column) -> Column:
    """First defect of an event, or NULL if its envelope is complete.

    ``fields`` are the payload's fields, NULL if it is not a JSON object. Whether such a
    payload is some other JSON value is looked at only then.
    """
    operation_known = F.coalesce(fields["__op"].isin(*OPERATIONS), F.lit(False))
    return (
        F.when(fields.isNull(), F.when(json_valid(payload), "missing_op").otherwise("invalid_json"))
        .when(~F.map_contains_key(fields, "__op"), "missing_op")
        .when(~operation_known, "invalid_op")
        .when(~F.map_contains_key(fields, "__table"), "missing_table")
        .when(~F.map_contains_key(fields, "__source_ts_ms"), "missing_source_ts")
    )


def _type_error(topic: Column, fields: Column) -> Column:
    wrong = F.lit(False)
    for spec in TABLES.values():
        wrong = F.when(topic == spec.topic, unreadable(fields, spec)).otherwise(wrong)
    return F.when(wrong, "type_error")


def quarantine(raw: DataFrame, detected_at: Column | None = None, *, type_errors: bool = False) -> DataFrame:
    """Events of the raw log whose JSON or envelope is defective, with the reason.

    ``type_errors`` also reports events with a complete envelope whose fields do not fit
    their table; the typed tables skip those without a trace otherwise.
    """
    stamp = F.current_timestamp() if detected_at is None else detected_at
    defect = reason(F.col("payload"), F.col("_json"))
    if type_errors:
        defect = F.coalesce(defect, _type_error(F.col("topic"), F.col("_json")))
    judged = open_object(raw).withColumn("reason", defect)
    return judged.where(F.col("reason").isNotNull()).select(
        "topic", "kafka_partition", "kafka_offset", "payload", "reason", stamp.alias("detected_at")
    )


def quarantine_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("topic", "reason").agg(F.count("*").alias("event_count"))
