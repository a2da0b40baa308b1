"""A snapshot in chunks beside a running log.

A table that changes while it is read is taken key range by key range. Around each range the
log's position is noted: ``low`` before its rows are read, ``high`` after. A row whose key has an
event in between may be read before or after that event, so it is dropped: its events tell
everything. All other rows are the state as of ``high`` and enter the change table with that version, so the events that
follow win over them. The log is never held up, and no lock is taken.

Ranges are fixed and stored before the first one is read. A chunk is committed by its
number when it is written, so a snapshot that is started again goes on with the chunks that lack, and what a
chunk that failed has left is not seen.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.session import checkpoint_dir
from cdcmart.sources.log import publish, read_published

MOST_CHUNKS = 10_000


class Chunk(NamedTuple):
    """Keys from ``first`` to before ``after``; null ends are open."""

    number: int
    first: int | None
    after: int | None

    def holds(self, key: Column) -> Column:
        inside = key.isNotNull()
        inside = inside if self.first is None else inside & (key >= self.first)
        return inside if self.after is None else inside & (key < self.after)


def key_ranges(rows: DataFrame, key: str = "id", rows_per_chunk: int = 1_000_000) -> list[Chunk]:
    """Ranges of about so many rows, at most ``MOST_CHUNKS``; the first and last are open, for keys to come."""
    count = math.ceil(rows.count() / rows_per_chunk)
    parts = max(1, min(count, MOST_CHUNKS))
    shares = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx(key, shares, 100 * parts)).first()[0] if shares else None
    ends = [None, *sorted(set(cuts or [])), None]
    return [Chunk(i, first, after) for i, (first, after) in enumerate(zip(ends, ends[1:]))]


def not_overtaken(rows: DataFrame, window: DataFrame, high: int, key: str = "id") -> DataFrame:
    """Rows read between two positions of the log, without those that an event of this ``window`` concerns."""
    still = rows.join(window.select(key).distinct(), key, "left_anti").select(*rows.columns)
    return still.withColumns({"_version": F.lit(high).cast("bigint"), "_deleted": F.lit(0)})


class ChunkedSnapshot:
    """``read`` gives the rows of a chunk as they are now, ``log`` the events after one position up to
    another (both with the key column), ``position`` where the log ends now."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        read: Callable[[Chunk], DataFrame],
        log: Callable[[int, int], DataFrame],
        position: Callable[[], int],
        key: str = "id",
    ):
        self.spark, self.path, self.key = spark, path, key
        self.read, self.log, self.position = read, log, position

    def plan(self, rows: DataFrame, rows_per_chunk: int = 1_000_000) -> list[Chunk]:
        """Fix the ranges by the rows of now, unless an earlier start has."""
        wanted = self.spark.createDataFrame(key_ranges(rows, self.key, rows_per_chunk), "number int, first bigint, after bigint")
        publish({"ranges": wanted.coalesce(1)}, f"{self.path}/plan", 0)
        return self.chunks()

    def chunks(self) -> list[Chunk]:
        rows = read_published(self.spark, f"{self.path}/plan", "ranges", newest_only=True).collect()
        return sorted(Chunk(row.number, row["first"], row.after) for row in rows)

    def run(self, limit: int | None = None) -> int:
        """Take the chunks that lack (at most ``limit``); the number taken."""
        checkpoint_dir(self.spark, scratch=True)
        done = self._done()
        open_chunks = [chunk for chunk in self.chunks() if chunk.number not in done][:limit]
        for chunk in open_chunks:
            low = self.position()
            # Read whole before the second position is taken.
            rows = self.read(chunk).checkpoint()
            high = self.position()
            window = self.log(low, high).where(chunk.holds(F.col(self.key)))
            publish({"rows": not_overtaken(rows, window, high, self.key)}, f"{self.path}/chunks", chunk.number)
        return len(open_chunks)

    def _done(self) -> set[int]:
        try:
            commits = self.spark.read.schema("batch_id bigint").parquet(f"{self.path}/chunks/_commits").distinct().collect()
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return set()
        return {row.batch_id for row in commits}

    def changes(self) -> DataFrame:
        """Rows of all finished chunks, as changes."""
        return read_published(self.spark, f"{self.path}/chunks", "rows")
