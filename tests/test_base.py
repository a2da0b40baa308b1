import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cdcmart.operators.state import compact
from cdcmart.sources.base import Store, added
from tests.conftest import rows

SCHEMA = "id bigint, name string, _version bigint, _deleted int"


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"), buckets=8)
    yield made
    made.discard()


def log(spark, told):
    return spark.createDataFrame(told, SCHEMA)


def files(store, **which):
    return {re.search(r"slot=(\d+)/(.*)$", f)[0]: f for f in store.read(**which).inputFiles()}


def test_merges_equal_compaction_of_the_whole_log(spark, store):
    told = [(i % 60, f"n{i}", (i * 37) % 400, int(i % 11 == 0)) for i in range(400)]
    parts = [told[:200], told[200:210], told[210:], told[205:220]]  # late, out of order, delivered twice
    for batch, part in enumerate(parts):
        assert store.merge_changes(log(spark, part), batch)
    assert rows(store.read()) == rows(compact(log(spark, told)))
    assert rows(store.read(upto=0)) == rows(compact(log(spark, told[:200])))
    assert not store.merge_changes(log(spark, [(1, "again", 999, 0)]), 1)
    assert store.versions() == [0, 1, 2, 3]


def test_untouched_buckets_keep_their_files_and_old_readers_their_rows(spark, store):
    store.merge_changes(log(spark, [(i, "old", 1, 0) for i in range(200)]), 0)
    reader, before = store.read(), files(store)
    change = log(spark, [(3, "new", 2, 0), (1000, "new", 2, 0)])
    touched = store.slots_of(change)
    store.merge_changes(change, 1)
    after = files(store)
    same = {f for f in before if int(re.search(r"slot=(\d+)", f)[1]) not in touched}
    assert len(same) >= 6 and all(after[f] == before[f] for f in same)
    assert not {before[f] for f in before if f not in same} & set(after.values())
    assert reader.where("name = 'new'").isEmpty() and store.read().where("name = 'new'").count() == 2
    assert len(store.drop_unreferenced(1, dt.datetime.now() + dt.timedelta(hours=1))) == 0  # the first folder is still in use
    store.merge_changes(log(spark, [(i, "all", 3, 0) for i in range(200)]), 2)
    assert store.drop_unreferenced(1, dt.datetime(2000, 1, 1)) == []
    assert len(store.drop_unreferenced(1, dt.datetime.now() + dt.timedelta(hours=1))) == 2
    assert store.read().where("name = 'all'").count() == 200


def test_stored_rows_are_not_moved(spark, store):
    store.merge_changes(log(spark, [(i, "old", 1, 0) for i in range(100)]), 0)
    change = log(spark, [(i, "new", 2, 0) for i in range(5)])
    touched = store.slots_of(change)
    merged = store._joined(store.read(slots=touched), change, lambda columns, stored: [F.col(f"old.{c}") for c in columns])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    stored, new = plan.split("SortMergeJoin")[1].split("FileScan parquet")[1], plan
    assert "Bucketed: true" in stored and "slot" in stored and new.count("Exchange") == 1
    assert plan.index("FileScan parquet") < plan.index("Exchange")  # only the changes' side has one
    # Nor by an aggregation of the bucket's column.
    whole = store.read().groupBy("id").agg(F.max("_version"))
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()


def test_rows_kept_by_another_column(spark, tmp_path):
    lines = Store(spark, str(tmp_path / "lines"), buckets=4, keys=("order_id", "id"), by=("order_id",))
    schema = "id bigint, order_id bigint, _version bigint, _deleted int"
    lines.merge_changes(spark.createDataFrame([(i, i // 3, 1, 0) for i in range(60)], schema), 0)
    lines.merge_changes(spark.createDataFrame([(4, 1, 2, 1), (99, 1, 2, 0)], schema), 1)
    slots = lines.slots_of(spark.createDataFrame([(1,)], "o bigint"), ["o"])
    assert len(slots) == 1
    found = lines.read(slots=slots).where("order_id = 1")
    assert rows(found.select("id", "_version", "_deleted")) == [(3, 1, 0), (4, 2, 1), (5, 1, 0), (99, 2, 0)]
    with pytest.raises(ValueError):
        Store(spark, "x", buckets=2, keys=("id",), by=("order_id",))
    lines.discard()


def test_sums_are_added_and_empty_rows_leave(spark, tmp_path):
    sums = Store(spark, str(tmp_path / "sums"), buckets=3, keys=("k",))
    schema = "k string, n bigint, amount decimal(20,2)"

    def frame(*told):
        return spark.createDataFrame([(k, n, __import__("decimal").Decimal(a)) for k, n, a in told], schema)

    sums.merge(frame(("a", 1, "1.50"), ("b", 2, "2.00")), 0, added(["n", "amount"]), F.col("n") != 0)
    sums.merge(frame(("a", 2, "-0.25"), ("b", -2, "-2.00"), ("c", 1, "7.00")), 1, added(["n", "amount"]), F.col("n") != 0)
    assert [(k, n, str(a)) for k, n, a in rows(sums.read())] == [("a", 3, "1.25"), ("c", 1, "7.00")]
    assert sums.read().schema.simpleString() == "struct<k:string,n:bigint,amount:decimal(20,2)>"
    sums.discard()


def test_an_interrupted_merge_leaves_the_old_version(spark, store, monkeypatch):
    store.merge_changes(log(spark, [(1, "old", 1, 0)]), 0)
    monkeypatch.setattr(Store, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.merge_changes(log(spark, [(1, "new", 2, 0)]), 1)
    monkeypatch.undo()
    assert rows(store.read()) == [(1, "old", 1, 0)]
    assert store.merge_changes(log(spark, [(1, "new", 2, 0)]), 1)
    assert rows(store.read()) == [(1, "new", 2, 0)]


def test_empty_batches_and_stores(spark, store):
    with pytest.raises(ValueError):
        store.read()
    assert store.merge_changes(log(spark, []), 0)
    assert rows(store.read()) == [] and store.read().columns == ["id", "name", "_version", "_deleted"]
    store.merge_changes(log(spark, [(1, "a", 1, 0)]), 1)
    store.merge_changes(log(spark, []), 2)
    assert rows(store.read()) == [(1, "a", 1, 0)]


def test_rows_kept_by_another_column_are_not_moved(spark, tmp_path):
    lines = Store(spark, str(tmp_path / "lines"), buckets=4, keys=("order_id", "id"), by=("order_id",))
    schema = "id bigint, order_id bigint, _version bigint, _deleted int"
    lines.merge_changes(spark.createDataFrame([(i, i // 3, 1, 0) for i in range(60)], schema), 0)
    change = spark.createDataFrame([(4, 1, 2, 1), (99, 1, 2, 0)], schema)
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    with lines._in_place():
        merged = lines._joined(lines.read(), change, lambda columns, stored: [F.col(f"old.{c}") for c in columns])
        plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FileScan parquet") < plan.index("Exchange") and plan.count("Exchange") == 1
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    lines.discard()
