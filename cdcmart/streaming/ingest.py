"""From the change log into the typed tables, the raw log and the quarantine."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from cdcmart.operators.bronze import typed_with_status
from cdcmart.operators.quarantine import quarantine
from cdcmart.operators.skew import lookup_join
from cdcmart.operators.state import current_state
from cdcmart.session import checkpoint_dir
from cdcmart.sources.changes import capture_raw, protect, table_changes
from cdcmart.sources.log import publish, read_published, write_log
from cdcmart.sources.specs import TableSpec

TYPED = "typed"


class TooManyBroken(RuntimeError):
    """A batch holds a larger share of unreadable messages than tolerated."""


def write_typed_batch(
    batch: DataFrame, batch_id: int, spec: TableSpec, path: str, broken_limit: tuple[int, float] | None = None
) -> None:
    """Add the readable changes of one batch, with what orders them across partitions.

    Unreadable messages are left out here; ``ingest_raw`` keeps them in the raw log and in
    the quarantine, with their reason. So a broken message stops nothing, however
    many there are. With a ``broken_limit`` (rows, per cent) a batch that exceeds both is
    refused: for loads that somebody watches. Its rows are counted while they are written, so the batch is
    computed once, and a refused batch gets no commit record, without which none of it is visible. The
    record is written last; a batch that is run again changes nothing.
    """
    typed = typed_with_status(protect(batch), spec, keep=("partition",))
    accept = None
    if broken_limit is not None:
        counted = Observation()
        typed = typed.observe(counted, F.count_if("_broken").alias("broken"), F.count("*").alias("total"))

        def accept() -> None:
            broken, total = counted.get["broken"], counted.get["total"]
            if broken > max(broken_limit[0], total * broken_limit[1] / 100):
                raise TooManyBroken(f"{spec.topic}: {broken} of {total} messages are unreadable, tolerated are {broken_limit}")

    publish({TYPED: typed.where(~F.col("_broken")).drop("_broken")}, path, batch_id, accept)


def write_raw_batch(batch: DataFrame, batch_id: int, raw_path: str, quarantine_path: str) -> None:
    """Every payload to the raw log, the defective ones also to the quarantine, both
    without sensitive values. Events whose fields do not fit their table are defective too.

    The time is taken once per batch, so both logs agree on it.
    """
    now = F.lit(dt.datetime.now(dt.timezone.utc))
    raw = capture_raw(protect(batch), now)
    write_log(raw, raw_path, "ingested_at", batch_id)
    write_log(quarantine(raw, now, type_errors=True), quarantine_path, "detected_at", batch_id)


def _start(
    stream: DataFrame, name: str, run: Callable[[DataFrame, int], None], once: bool, checkpoint: str | None
) -> StreamingQuery:
    """Progress is kept below the shared checkpoint folder (or ``checkpoint``): a restarted
    stream goes on behind the last finished batch."""
    folder = f"{checkpoint or checkpoint_dir(stream.sparkSession)}/streams/{name}"
    writer: DataStreamWriter = stream.writeStream.queryName(name).foreachBatch(run)
    writer = writer.option("checkpointLocation", folder)
    return (writer.trigger(availableNow=True) if once else writer).start()


def ingest_table(
    log: DataFrame,
    spec: TableSpec,
    path: str,
    *,
    broken_limit: tuple[int, float] | None = None,
    once: bool = False,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Stream one table's changes into its typed change table."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write_typed_batch(batch, batch_id, spec, path, broken_limit)

    return _start(table_changes(log, spec), f"typed-{spec.name}", run, once, checkpoint)


def ingest_raw(
    log: DataFrame, raw_path: str, quarantine_path: str, *, once: bool = False, checkpoint: str | None = None
) -> StreamingQuery:
    """Stream all payloads into the raw log and the quarantine, apart from the typed tables."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write_raw_batch(batch, batch_id, raw_path, quarantine_path)

    return _start(log, "raw", run, once, checkpoint)


def read_typed(spark: SparkSession, path: str) -> DataFrame:
    """The committed batches of a typed change table written by ``ingest_table``.

    For topics of several partitions order its changes by ``state.SEVERAL_PARTITIONS``.
    """
    return read_published(spark, path, TYPED)


def snapshot_costs(lines: DataFrame, product_changes: DataFrame) -> DataFrame:
    """Lines of a batch with the unit cost of their product as it is now.

    The streaming form of ``operators.asof.unit_cost_asof``: used inside a batch, where
    "now" is the moment the line is written.
    """
    products = current_state(product_changes)
    return lookup_join(
        lines.drop("unit_cost_at_order"), products, {"product_id": "id"}, {"unit_cost_at_order": "unit_cost"}
    )
