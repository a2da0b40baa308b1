import pytest
from conftest import rows
from pyspark.sql import functions as F

from cdcmart.operators.state import current_state
from cdcmart.sources.chunks import Chunk, ChunkedSnapshot, key_ranges, not_overtaken


class Source:
    """A table with a log; every look at the position lets some more events happen."""

    def __init__(self, spark, events, step):
        self.spark, self.events, self.step, self.now = spark, events, step, 0

    def position(self):
        self.now = min(len(self.events), self.now + self.step)
        return self.now

    def state(self, at):
        table = {i: f"start {i}" for i in range(0, 100, 2)}
        for offset, (key, name) in enumerate(self.events[:at], 1):
            table[key] = name
            if name is None:
                del table[key]
        return table

    def read(self, chunk):
        # The rows are read some events after the first position, and before the second one.
        self.now = min(len(self.events), self.now + self.step)
        told = self.spark.createDataFrame(sorted(self.state(self.now).items()), "id bigint, name string")
        return told.where(chunk.holds(F.col("id")))

    def log(self, low, high):
        told = [(key, name, offset, int(name is None)) for offset, (key, name) in enumerate(self.events, 1) if low < offset <= high]
        return self.spark.createDataFrame(told, "id bigint, name string, _version bigint, _deleted int")


def test_snapshot_beside_the_log_with_restarts(spark, tmp_path):
    events = []
    for i in range(120):
        key = (i * 31) % 130
        events.append((key, f"event {i}"))
        if i % 6 == 0:
            events.append((key, None))
    source = Source(spark, events, 4)
    for start in range(3):  # the third one takes the rest
        snapshot = ChunkedSnapshot(spark, str(tmp_path / "s"), source.read, source.log, source.position)
        chunks = snapshot.plan(spark.range(0, 100, 2), 10)
        assert len(chunks) == 5
        assert snapshot.run(None if start == 2 else 2) == (1 if start == 2 else 2)
    assert snapshot.run() == 0
    both = snapshot.changes().unionByName(source.log(0, len(events)))
    assert dict(rows(current_state(both).select("id", "name"))) == source.state(len(events))


def test_a_chunk_that_failed_is_taken_again(spark, tmp_path, monkeypatch):
    source = Source(spark, [(0, "new")], 0)
    snapshot = ChunkedSnapshot(spark, str(tmp_path / "s"), source.read, source.log, source.position)
    snapshot.plan(spark.range(0, 100, 2), 30)
    monkeypatch.setattr(source, "log", lambda low, high: 1 / 0)
    snapshot.log = source.log
    with pytest.raises(ZeroDivisionError):
        snapshot.run()
    snapshot.log = lambda low, high: Source.log(source, low, high)
    assert snapshot.run() == 2 and snapshot.changes().count() == 50


def test_overtaken_rows_are_dropped(spark):
    read = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    window = spark.createDataFrame([(2,), (2,), (9,)], "id bigint")
    assert rows(not_overtaken(read, window, 7)) == [(1, "a", 7, 0)]


def test_ranges_cover_all_keys_once(spark):
    told = spark.range(1000).select((F.col("id") * F.col("id") - 500).alias("id"))
    ranges = key_ranges(told, "id", 100)
    assert len(ranges) == 10 and ranges[0].first is None and ranges[-1].after is None
    held = [told.where(chunk.holds(F.col("id"))).count() for chunk in ranges]
    assert sum(held) == 1000 and max(held) < 130
    assert key_ranges(told.limit(0)) == [Chunk(0, None, None)]
