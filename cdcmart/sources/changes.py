"""Change events in: log readers, envelope unwrapping, snapshots."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.functions import wire
from cdcmart.sources.specs import SENSITIVE, TABLES, TableSpec

#: What a stream reads at most in one batch: events, or files.
TRIGGER = {"kafka": {"maxOffsetsPerTrigger": "10000000"}, "files": {"maxFilesPerTrigger": "10000"}}
LOG_SCHEMA = "topic string, `partition` int, `offset` bigint, payload string"


def read_changes(
    spark: SparkSession,
    source: str,
    *,
    fmt: str = "json",
    streaming: bool = False,
    tables: Iterable[str] = tuple(TABLES),
    **options: str,
) -> DataFrame:
    """The change log as (topic, partition, offset, payload).

    ``fmt="kafka"`` reads the topics of ``tables`` from the brokers named in
    ``source``; pass ``minPartitions`` to read a one-partition topic with several
    tasks. ``json`` and ``parquet`` read files of the same four columns. A stream takes
    in a bounded part of the log at a time (``TRIGGER``); options overrule that.
    """
    if streaming:
        options = TRIGGER["kafka" if fmt == "kafka" else "files"] | options
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        topics = ",".join(TABLES[name].topic for name in tables)
        log = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", source)
            .option("subscribe", topics)
            .option("startingOffsets", "earliest")
            .options(**options)
            .load()
        )
        return log.select("topic", "partition", "offset", F.col("value").cast("string").alias("payload"))
    return reader.format(fmt).schema(LOG_SCHEMA).options(**options).load(source)


def table_changes(log: DataFrame, spec: TableSpec) -> DataFrame:
    """The part of a log that belongs to one table."""
    return log.where(F.col("topic") == spec.topic)


def unwrap_envelope(log: DataFrame) -> DataFrame:
    """Before/after envelopes to flat payloads.

    The new row wins; a delete keeps the old row and is marked ``__deleted``. The
    operation, table and source time are added to the row; a column of the row that is called like one of
    them gives way, and of a repeated column the last value counts. Messages without a value
    (log compaction markers) are dropped, as are columns that must not leave the
    source. Row values keep their JSON types: they travel as VARIANT. A text that is no
    complete envelope stays, without sensitive values, for the quarantine to find.
    """
    row = "map<string,variant>"
    envelope = f"struct<before: {row}, after: {row}, op: string, source: struct<`table`: string, ts_ms: bigint>, `{wire.MARK}`: string>"
    opened = wire.open_as(log.where(F.col("payload").isNotNull()), envelope)
    source = F.col("_json.source")
    table = F.coalesce(source["table"], _table_of(F.col("topic")))
    added = {
        "__op": F.col("_json.op").cast("variant"),
        "__table": table.cast("variant"),
        "__source_ts_ms": source["ts_ms"].cast("variant"),
        "__deleted": F.when(F.col("_json.op") == "d", "true").otherwise("false").cast("variant"),
    }
    entries = F.map_entries(F.coalesce("_json.after", "_json.before"))
    kept = _last_of_each(entries, lambda name: ~name.isin(*added) & ~_sensitive(table, name))
    extra = F.array(*[F.struct(F.lit(name).alias("key"), value.alias("value")) for name, value in added.items()])
    flat = F.to_json(F.map_from_entries(F.concat(kept, extra)))
    return protect(opened.withColumn("payload", F.coalesce(flat, F.col("payload"))).drop("_json"))


def _last_of_each(entries: Column, wanted: Callable[[Column], Column]) -> Column:
    """Map entries whose key is ``wanted``; of equal keys the last."""

    def last(entry: Column, i: Column) -> Column:
        later = F.slice(entries, i + 2, F.size(entries))
        return wanted(entry["key"]) & ~F.exists(later, lambda other: other["key"] == entry["key"])

    return F.filter(entries, last)


def _table_of(topic: Column) -> Column:
    return F.element_at(F.split(topic, r"\."), -1)


def _sensitive(table: Column, name: Column) -> Column:
    """Whether a column must not leave its source. Of an unknown table no such name may."""
    unknown = ~F.coalesce(table.isin(*TABLES), F.lit(False))
    hidden = unknown & name.isin(*_SENSITIVE_NAMES)
    for owner, columns in SENSITIVE.items():
        hidden = hidden | ((table == owner) & name.isin(*columns))
    return F.coalesce(hidden, F.lit(False))


_SENSITIVE_NAMES = sorted({column for columns in SENSITIVE.values() for column in columns})
# A sensitive name and its value in a text that cannot be parsed; the value may have no end.
_SENSITIVE_TEXT = r'"(' + "|".join(_SENSITIVE_NAMES) + r')"\s*:\s*("(?:[^"\\]|\\.)*("|$)|[^,}\]\s]*)'


def protect(log: DataFrame) -> DataFrame:
    """The log without sensitive values: what is stored has passed here.

    A flat row loses the columns; in any other text their values become ``***``. Payloads
    without such a name, the most by far, pass as they are.
    """
    suspect = F.col("payload").rlike("|".join([*_SENSITIVE_NAMES, r"\\u00"]))
    opened = wire.open_as(log.withColumn("_suspect", F.when(suspect, F.col("payload"))), "map<string,variant>", "_suspect")
    table = _table_of(F.col("topic"))
    names = F.map_keys("_json")
    plain = ~F.array_contains(names, "before") & ~F.array_contains(names, "after")
    holds = F.exists(names, lambda name: _sensitive(table, name))
    flat = F.to_json(F.map_from_entries(_last_of_each(F.map_entries("_json"), lambda n: ~_sensitive(table, n))))
    hidden = F.regexp_replace("payload", _SENSITIVE_TEXT, '"$1":"***"')
    owns = _sensitive_topic(table)
    safe = F.when(~suspect | suspect.isNull(), F.col("payload")).when(plain & holds, flat).when(plain, F.col("payload"))
    return opened.withColumn("payload", safe.when(owns, hidden).otherwise(F.col("payload"))).drop("_json", "_suspect")


def _sensitive_topic(table: Column) -> Column:
    """Whether a table has sensitive columns, or is unknown."""
    return ~F.coalesce(table.isin(*[name for name in TABLES if name not in SENSITIVE]), F.lit(False))


def drop_sensitive(rows: DataFrame, table: str) -> DataFrame:
    """Source rows without the columns that must not be captured."""
    return rows.drop(*SENSITIVE.get(table, ()))


def snapshot_as_changes(
    rows: DataFrame, table: str, source_ts_ms: Column, offset: Column, *, op: str = "r"
) -> DataFrame:
    """Rows of a source table as log records: the initial snapshot carries operation ``r``."""
    rows = drop_sensitive(rows, table)
    envelope = [
        F.lit(op).alias("__op"),
        F.lit(table).alias("__table"),
        source_ts_ms.cast("bigint").alias("__source_ts_ms"),
    ]
    payload = F.to_json(F.struct(*[F.col(c) for c in rows.columns], *envelope), {"ignoreNullFields": "false"})
    return rows.select(
        F.lit(TABLES[table].topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
        payload.alias("payload"),
    )


def capture_raw(log: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """The append-only copy of every payload. ``ingested_at`` is a parameter so that a
    replay can be given the original time."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return log.select(
        "topic",
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        "payload",
        F.date_trunc("second", stamp).alias("ingested_at"),
    )
