"""The log with an index of its files."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cdcmart.sources.indexed import IndexedLog

NOW = dt.datetime(2024, 3, 4, 12, tzinfo=dt.timezone.utc)
SCHEMA = "topic string, kafka_partition int, kafka_offset bigint, payload string, ingested_at timestamp"


def events(spark, offsets, topic="t", age=lambda offset: 0, partition=0):
    records = [(topic, partition, n, f"{topic}{n}", NOW - dt.timedelta(hours=age(n))) for n in offsets]
    return spark.createDataFrame(records, SCHEMA).repartition(3)


def files(frame):
    return {path.rsplit("/", 1)[1] for path in frame.inputFiles()}


def offsets(frame):
    return sorted(row.kafka_offset for row in frame.collect())


@pytest.fixture
def in_ranges(spark):
    """Small ranges are not merged, so that there is something to leave out."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_replay_opens_only_files_that_reach_the_offset(spark, in_ranges, tmp_path):
    log = IndexedLog(spark, str(tmp_path / "log"))
    # One topic holds most rows; its files are told apart by offset.
    assert log.append(events(spark, range(400)).unionByName(events(spark, range(20), "u")), 0)
    assert log.append(events(spark, range(400, 500)), 1)
    assert not log.append(events(spark, range(400, 500)), 1) and not log.append(events(spark, [9]), 0)
    everything = log.read()
    assert everything.count() == 520 and log.index().agg(F.sum("n_rows")).first()[0] == 520
    late = log.replay("t", 0, 450)
    assert offsets(late) == list(range(450, 500))
    assert len(files(late)) < len(files(everything)) / 2
    part = log.replay("t", 0, 10, until=30)
    assert offsets(part) == list(range(10, 30)) and len(files(part)) <= 2
    assert offsets(log.replay("u", 0, 0)) == list(range(20))
    assert offsets(log.replay("t", 1, 0)) == offsets(log.replay("none", 0, 0)) == []
    # Each file of a batch holds a stretch: no offset lies in two files' bounds.
    bounds = rows(log.index().where("topic = 't'").select("first_offset", "last_offset"))
    ordered = sorted(bounds)
    assert all(high < low for (_, high), (low, _) in zip(ordered, ordered[1:], strict=False))


def test_expiry_rewrites_only_files_that_cross_the_limit(spark, in_ranges, tmp_path):
    log = IndexedLog(spark, str(tmp_path / "log"))
    log.append(events(spark, range(0, 300), age=lambda n: 300 - n), 0)
    log.append(events(spark, range(300, 310)), 1)
    before, begun = files(log.read()), log.read()
    first = log.versions()[-1]
    assert log.expire(7, NOW) == first + 1
    kept = log.read()
    assert offsets(kept) == list(range(132, 310))
    # Files inside the period keep their names; one or two crossed the limit.
    assert 0 < len(files(kept) - before) <= 4 and len(files(kept) & before) >= 2
    # A reader that began before, and the version before, see everything; so does nobody later.
    assert begun.count() == 310 and log.read(first).count() == 310
    assert log.expire(7, NOW) is None
    assert log.during(NOW - dt.timedelta(hours=2), NOW).count() == 2
    # Old files stay while a version names them.
    later = NOW + dt.timedelta(days=36500)
    log.drop_unreferenced(2, later)
    assert log.read(first).count() == 310
    log.drop_unreferenced(1, dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc))
    assert log.read(first).count() == 310
    assert log.drop_unreferenced(1, later) > 0 and offsets(log.read()) == list(range(132, 310))
    # Appending goes on behind the expiry, everything may expire, and the log is still a log.
    assert log.append(events(spark, [310]), 2) and log.read().count() == 179
    assert log.expire(7, NOW + dt.timedelta(days=30)) is not None and log.read().count() == 0
    assert log.append(events(spark, [311]), 3) and offsets(log.read()) == [311]


def test_empty_batches_nulls_and_a_failed_batch(spark, tmp_path):
    log = IndexedLog(spark, str(tmp_path / "log"))
    assert log.index().count() == 0
    assert log.append(spark.createDataFrame([], SCHEMA), 0) and log.read().count() == 0
    odd = spark.createDataFrame([(None, 0, 1, "a", NOW), ("t", None, 2, "b", NOW), ("t", 0, None, "c", NOW), ("t", 0, 4, None, None)], SCHEMA)
    assert log.append(odd, 1) and log.read().count() == 4
    assert offsets(log.replay("t", 0, 0)) == [4]
    # Files of a batch that died before its manifest are not read.
    log._write(events(spark, range(50)))
    assert log.read().count() == 4
    # Without a time a row expires at once.
    assert log.expire(7, NOW) is not None and log.read().count() == 3
    log.discard()
    assert not (tmp_path / "log").exists()
