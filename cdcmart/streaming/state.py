"""Live current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_current_state(
    changes: DataFrame, key: str = "id", version: str | Sequence[str] = "_version"
) -> DataFrame:
    """The newest row per key of an unbounded change stream, tombstones included.

    State is one row per key, however many changes arrive. Write it in update mode and
    drop ``_deleted`` rows when reading; a late older change never wins.
    """
    newest = changes.groupBy(key).agg(F.max_by(F.struct("*"), F.struct(*([version] if isinstance(version, str) else version))).alias("row"))
    return newest.select("row.*")


def stream_change_feed(
    changes: DataFrame, time: str, remember: str, key: str = "id", version: str | Sequence[str] = "_version"
) -> DataFrame:
    """(key, kind, old, new, at) for each change of the live state: ``kind`` is insert, update or delete, ``old`` and ``new``
    are the row before and after as structs (null where there is none).

    A change wins over the state if its version is higher; of several changes of a key in one batch the newest
    counts. A deleted key's tombstone stays for ``remember`` (like "2 days") of the time in column ``time`` and then leaves,
    so state is one row per live key and one per recent delete. Changes older than that are late and dropped before they
    meet the state: none can bring back a row whose tombstone has left. ``remember`` must therefore exceed the delay of
    the log. A null time counts as the epoch. A tombstone of a key that is not live gives no change.

    Needs the RocksDB state store. Write it in append mode.
    """
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    names = [version] if isinstance(version, str) else list(version)
    row_type = changes.schema.simpleString()

    # Defined here, so that it reaches Python workers that have no copy of this package.
    class Newest(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.newest = handle.getValueState("newest", f"row {row_type}")

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            def order(row) -> tuple:
                return tuple(row[name] for name in names)

            old = self.newest.get()[0] if self.newest.exists() else None
            told = max(rows, key=lambda given: order(given["row"]))
            new = told["row"]
            if old is not None and order(new) <= order(old):
                return
            self.newest.update((new,))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if new["_deleted"]:
                self.handle.registerTimer(told["_at"])
            before, after = (None if row is None or row["_deleted"] else row for row in (old, new))
            if before is not None or after is not None:
                kind = "insert" if before is None else "delete" if after is None else "update"
                yield Row(key=key[0], kind=kind, old=before, new=after, at=told["_at"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
            self.newest.clear()
            yield from ()

        def close(self) -> None:
            pass

    told = changes.withColumn("_time", F.coalesce(time, F.timestamp_seconds(F.lit(0)))).withWatermark("_time", remember)
    told = told.select(F.col(key).alias("_key"), "_time", F.unix_millis("_time").alias("_at"), F.struct(*changes.columns).alias("row"))
    kind = changes.schema[key].dataType.simpleString()
    feed = told.groupBy("_key").transformWithState(
        Newest(), f"key {kind}, kind string, old {row_type}, new {row_type}, at bigint", "append", "eventTime"
    )
    return feed.withColumn("at", F.timestamp_millis("at"))
