"""The live state's change feed, which forgets."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cdcmart.operators.state import current_state
from cdcmart.streaming.state import stream_change_feed

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "id bigint, v string, price decimal(15,2), at timestamp, _version bigint, _deleted int"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


@pytest.fixture
def feed(spark, rocks, tmp_path):
    """Runs a stream over what was added, from its last progress on; every call is a restart."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def add(*changes) -> dict:
        made = [(key, v, None, None if hour is None else START + dt.timedelta(hours=hour), version, int(v is None)) for key, v, hour, version in changes]
        spark.createDataFrame(made, SCHEMA).withColumn("price", F.col("_version").cast("decimal(15,2)") / 4).select(
            "id", "v", F.col("price").cast("decimal(15,2)").alias("price"), "at", "_version", "_deleted"
        ).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        query = (
            stream_change_feed(stream, "at", "10 hours").writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start(target)
        )
        assert query.awaitTermination(120)
        return query.lastProgress["stateOperators"][0]

    add.found = lambda: spark.read.parquet(target)
    add.log = lambda: spark.read.schema(SCHEMA).parquet(source)
    return add


def changes_of(frame, key):
    told = frame.where(F.col("key") == key).orderBy("at").select("kind", "old.v", "new.v").collect()
    return [tuple(row) for row in told]


def test_feed_tells_old_and_new_rows_over_restarts(feed):
    feed((1, "a", 0, 1), (2, "b", 0, 2), (3, None, 0, 3))
    feed((1, "c", 1, 5), (1, "x", 1, 4), (2, None, 2, 6))
    feed((1, "c", 1, 5), (2, "late", 1, 1), (2, "back", 3, 7))
    found = feed.found()
    assert changes_of(found, 1) == [("insert", None, "a"), ("update", "a", "c")]
    assert changes_of(found, 2) == [("insert", None, "b"), ("delete", "b", None), ("insert", None, "back")]
    assert changes_of(found, 3) == []
    # The last new row of each key is the state of the whole log, decimals and times included.
    last = found.groupBy("key").agg(F.max_by(F.struct("new.*"), "at").alias("row")).select("row.*")
    assert rows(last) == rows(current_state(feed.log()))


def test_tombstones_leave_and_late_changes_bring_nothing_back(feed):
    deleted = range(2, 40)
    feed((1, "a", 0, 1), *[(n, "b", 0, 2) for n in deleted])
    feed(*[(n, None, 1, 3) for n in deleted])
    feed((50, "c", 30, 10))
    state = feed((51, "d", 31, 11))
    # One row per live key, none of the 38 deleted ones.
    assert state["numRowsTotal"] == 3
    feed((2, "old", 0.5, 2), (52, "undated", None, 12))
    found = feed.found()
    assert changes_of(found, 2) == [("insert", None, "b"), ("delete", "b", None)]
    assert changes_of(found, 52) == []
    # A key whose tombstone has left can be used anew.
    feed((2, "new", 32, 13), (1, "e", 32, 14))
    found = feed.found()
    assert changes_of(found, 2)[2:] == [("insert", None, "new")] and changes_of(found, 1) == [("insert", None, "a"), ("update", "a", "e")]


def test_a_key_that_comes_back_keeps_no_timer(feed):
    feed((1, "a", 0, 1))
    feed((1, None, 1, 2))
    feed((1, "b", 2, 3))
    feed((9, "z", 40, 9))
    feed((9, "y", 41, 10))
    feed((1, "c", 42, 11))
    assert changes_of(feed.found(), 1) == [("insert", None, "a"), ("delete", "a", None), ("insert", None, "b"), ("update", "b", "c")]
