"""Logs, retention, publishing, compaction, session settings."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cdcmart.operators.state import align_schema, base_and_changes, compact, current_state
from cdcmart.session import RUNTIME, checkpoint_dir
from cdcmart.sources.log import drop_expired, expire, publish, read_published, save_bucketed, write_log
from cdcmart.sources.specs import QUARANTINE_DAYS, RAW_DAYS, TABLES

NOW = dt.datetime(2024, 3, 4, 12, tzinfo=dt.timezone.utc)


def aged(spark, days):
    records = [("t", 0, n, NOW - dt.timedelta(days=age)) for n, age in enumerate(days)]
    return spark.createDataFrame(records, "topic string, kafka_partition int, kafka_offset bigint, ingested_at timestamp")


def test_retention(spark):
    kept = [r.kafka_offset for r in expire(aged(spark, [8, 7, 1]), "ingested_at", RAW_DAYS, F.lit(NOW)).collect()]
    assert sorted(kept) == [1, 2]
    assert expire(aged(spark, [29, 31]), "ingested_at", QUARANTINE_DAYS, F.lit(NOW)).count() == 1


def test_log_is_partitioned_and_expired_by_month(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_log(aged(spark, [0, 8, 40]), path, "ingested_at", 0)
    write_log(aged(spark, [1]), path, "ingested_at", 1)
    write_log(aged(spark, [1]), path, "ingested_at", 1)
    log = spark.read.parquet(path)
    assert log.count() == 4 and {r.month for r in log.select("month").collect()} == {202401, 202402, 202403}
    kept = expire(log, "ingested_at", RAW_DAYS, F.lit(NOW))
    assert kept.count() == 2
    assert "PartitionFilters: [isnotnull(month" in kept._jdf.queryExecution().toString()
    # January lies wholly before the retention period; the boundary month stays, filtered.
    assert drop_expired(spark, path, RAW_DAYS, NOW) == [202401] and drop_expired(spark, path, RAW_DAYS, NOW) == []
    assert not (tmp_path / "raw" / "month=202401").exists()
    log = spark.read.parquet(path)
    assert log.count() == 3 and expire(log, "ingested_at", RAW_DAYS, F.lit(NOW)).count() == 2


def test_publish_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    one, two = spark.range(3), spark.range(5)
    assert publish({"a": one, "b": two}, path, 1)
    # A batch whose commit record is missing: data written, then the job died.
    spark.range(100).write.parquet(f"{path}/a/batch_id=2")
    assert read_published(spark, path, "a").count() == 3
    assert publish({"a": spark.range(10, 12), "b": two}, path, 2)
    assert not publish({"a": spark.range(999), "b": two}, path, 2)
    assert rows(read_published(spark, path, "a")) == [(0,), (1,), (10,), (11,), (2,)]
    assert rows(read_published(spark, path, "a", newest_only=True)) == [(10,), (11,)]


def changes(spark):
    return spark.createDataFrame(
        [(1, "a", 1, 0), (1, "b", 5, 0), (2, "c", 2, 0), (2, "", 3, 1), (3, "d", 4, 0), (3, "d", 4, 0)],
        "id bigint, v string, _version bigint, _deleted int",
    )


def test_current_state(spark):
    assert rows(current_state(changes(spark))) == [(1, "b", 5, 0), (3, "d", 4, 0)]
    assert rows(current_state(changes(spark), include_deleted=True)) == [(1, "b", 5, 0), (2, "", 3, 1), (3, "d", 4, 0)]
    wide = changes(spark).withColumn("partition", F.col("_version") % 2)
    assert current_state(wide, "id", ["partition", "_version"]).where("id = 1").first().v == "b"


def test_compaction_keeps_tombstones(spark, tmp_path):
    path = str(tmp_path / "users")
    publish({"users": compact(changes(spark))}, path, 1)
    compacted = read_published(spark, path, "users", newest_only=True)
    late = spark.createDataFrame([(2, "late", 2, 0)], compacted.schema)
    assert rows(current_state(compacted.unionByName(late))) == rows(current_state(changes(spark)))


def test_base_and_changes(spark):
    """The same rows as the newest versions of all; changes older than the base lose."""
    base = compact(changes(spark))
    since = spark.createDataFrame(
        [(1, "late", 4, 0), (2, "again", 9, 0), (3, "", 8, 1), (4, "new", 1, 0), (4, "newer", 2, 0), (5, "", 3, 1)], base.schema
    )
    found = base_and_changes(base, since)
    assert rows(found) == rows(current_state(base.unionByName(since))) == [(1, "b", 5, 0), (2, "again", 9, 0), (4, "newer", 2, 0)]
    assert rows(base_and_changes(base, since.limit(0))) == rows(current_state(base))


def test_schema_alignment(spark):
    old = spark.createDataFrame([(1, 2, 3, 0, 0)], "id int, order_id int, product_id int, _version int, _deleted int")
    spec = TABLES["orderdetails"]
    aligned = align_schema(old, spec)
    assert aligned.columns == [*[name for name, _ in spec.fields], "_version", "_deleted"]
    assert aligned.first().unit_cost_at_order is None and aligned.schema["id"].dataType.simpleString() == "bigint"


def test_bucketed_tables_join_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        save_bucketed(spark.range(100).withColumnRenamed("id", "order_id"), "heads", "order_id", 4)
        save_bucketed(spark.range(300).select((F.col("id") % 100).alias("order_id"), "id"), "lines", "order_id", 4)
        joined = spark.table("heads").join(spark.table("lines"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("drop table if exists heads")
        spark.sql("drop table if exists lines")


def test_session(spark):
    assert {key: spark.conf.get(key) for key in RUNTIME} == RUNTIME
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(Exception, match="overflow|out of range|NUMERIC_VALUE_OUT_OF_RANGE"):
        spark.range(1).select(F.lit("12345678901234567").cast("decimal(15,2)")).collect()
