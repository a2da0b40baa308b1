"""Ingestion as a stream: restarts, broken rows, raw log, live state."""

from types import SimpleNamespace

import pytest
from conftest import rows
from shop import Shop

from cdcmart.operators.bronze import typed_bronze
from cdcmart.operators.state import SEVERAL_PARTITIONS, compact, current_state
from cdcmart.plans.warehouse import Warehouse
from cdcmart.session import checkpoint_dir
from cdcmart.sources.changes import read_changes, table_changes
from cdcmart.sources.specs import TABLES
from cdcmart.streaming import ingest
from cdcmart.streaming.state import stream_current_state

USERS = TABLES["users"]


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return str(tmp_path / "in"), str(tmp_path / "out")


def append(spark, shop: Shop, folder: str) -> None:
    shop.log(spark).coalesce(1).write.mode("append").json(folder)
    shop.records = []


def run(stream) -> None:
    query = stream
    query.awaitTermination(120)
    assert not query.isActive


def stream(spark, folder):
    return read_changes(spark, folder, streaming=True)


def test_restart_loses_and_repeats_nothing(spark, folders):
    source, target = folders
    shop = Shop()
    for number in (1, 2, 3):
        shop.change("users", id=number, username=f"u{number}", created_at=0)
    append(spark, shop, source)
    run(ingest.ingest_table(stream(spark, source), USERS, target, once=True, checkpoint=target + "-progress"))
    shop.change("users", "u", id=2, username="new", created_at=0)
    shop.change("users", "d", id=3)
    append(spark, shop, source)
    run(ingest.ingest_table(stream(spark, source), USERS, target, once=True, checkpoint=target + "-progress"))
    typed = ingest.read_typed(spark, target)
    assert sorted(r._version for r in typed.collect()) == [0, 1, 2, 3, 4]
    assert rows(current_state(typed).select("id", "username")) == [(1, "u1"), (2, "new")]
    batch = typed_bronze(table_changes(read_changes(spark, source), USERS), USERS)
    assert rows(current_state(batch)) == rows(current_state(typed).select(*batch.columns))


def test_batch_run_again_replaces_itself(spark, folders):
    _, target = folders
    shop = Shop()
    shop.change("users", id=1, username="a", created_at=0)
    for _ in range(2):
        ingest.write_typed_batch(shop.log(spark), 0, USERS, target)
    assert ingest.read_typed(spark, target).count() == 1


@pytest.mark.parametrize("broken", [99, 101])
def test_broken_rows_stop_nothing_unless_a_limit_is_asked_for(spark, folders, broken):
    source, target = folders
    shop = Shop()
    shop.change("users", id=1, username="a", created_at=0)
    for _ in range(broken):
        shop.raw("users", '{"id":"n/a","__op":"c","__table":"users","__source_ts_ms":1}')
    frame = shop.log(spark)
    if broken > 100:
        with pytest.raises(ingest.TooManyBroken):
            ingest.write_typed_batch(frame, 0, USERS, target, broken_limit=(100, 1.0))
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            ingest.read_typed(spark, target)
    ingest.write_typed_batch(frame, 0, USERS, target)
    assert ingest.read_typed(spark, target).count() == 1
    ingest.write_raw_batch(frame, 0, f"{target}-raw", f"{target}-quarantine")
    bad = spark.read.parquet(f"{target}-quarantine")
    assert bad.count() == broken and {r.reason for r in bad.collect()} == {"type_error"}
    shop.change("users", id=2, username="b", created_at=0)
    append(spark, shop, source)
    run(ingest.ingest_table(stream(spark, source), USERS, target + "-2", once=True, checkpoint=target + "-progress"))
    assert ingest.read_typed(spark, target + "-2").count() == 2


def test_changes_of_several_partitions_are_ordered_by_source_time(spark, folders):
    def payload(name, time):
        return f'{{"id":1,"username":"{name}","__op":"u","__source_ts_ms":{time}}}'

    records = [(USERS.topic, 0, 900, payload("old", 10)), (USERS.topic, 1, 3, payload("new", 20))]
    schema = "topic string, `partition` int, `offset` bigint, payload string"
    ingest.write_typed_batch(spark.createDataFrame(records, schema), 0, USERS, folders[1])
    typed = ingest.read_typed(spark, folders[1])
    assert current_state(typed, "id", SEVERAL_PARTITIONS).first().username == "new"
    assert compact(typed, "id", SEVERAL_PARTITIONS).count() == 1
    assert Warehouse(spark, {"users": typed}, version=SEVERAL_PARTITIONS).users().first().username == "new"


@pytest.mark.parametrize(("master", "scratch"), [("local[4]", False), ("spark://host:7077", True)])
def test_a_checkpoint_folder_must_be_named(master, scratch):
    """Also on one machine, but for the data of one run."""
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf={})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session, scratch=scratch)


def test_raw_log_and_quarantine(spark, folders):
    source, target = folders
    shop = Shop()
    shop.change("users", id=1, username="a", created_at=0)
    shop.raw("users", "{bad")
    shop.raw("brands", "{}")
    append(spark, shop, source)
    logs = f"{target}/raw", f"{target}/quarantine"
    run(ingest.ingest_raw(stream(spark, source), *logs, once=True, checkpoint=target + "-progress"))
    raw = spark.read.parquet(f"{target}/raw")
    assert raw.count() == 3 and {"month", "ingested_at", "kafka_offset"} <= set(raw.columns)
    bad = spark.read.parquet(f"{target}/quarantine")
    assert rows(bad.select("topic", "reason")) == [
        ("shop.public.brands", "missing_op"),
        ("shop.public.users", "invalid_json"),
    ]


def test_live_state(spark, folders, tmp_path):
    """The last update of each key equals the state of the whole log, deletes included."""
    source, _ = folders
    shop = Shop()
    shop.change("users", id=1, username="a", created_at=0)
    shop.change("users", id=2, username="b", created_at=0)
    append(spark, shop, source)
    changes = typed_bronze(table_changes(stream(spark, source), USERS), USERS)
    query = (
        stream_current_state(changes).writeStream.outputMode("complete").format("memory").queryName("live_users")
        .option("checkpointLocation", str(tmp_path / "live")).start()
    )
    query.processAllAvailable()
    shop.change("users", "u", id=1, username="c", created_at=0)
    shop.change("users", "d", id=2)
    append(spark, shop, source)
    query.processAllAvailable()
    query.stop()
    live = spark.table("live_users")
    assert rows(live.select("id", "username", "_deleted")) == [(1, "c", 0), (2, "", 1)]
    batch = typed_bronze(table_changes(read_changes(spark, source), USERS), USERS)
    assert rows(live) == rows(current_state(batch, include_deleted=True).select(*live.columns))


def test_cost_snapshot_inside_a_batch(spark):
    shop = Shop().catalog()
    shop.change("products", "u", id=1, product_name="P1", unit_cost="77.00", created_at=0)
    shop.change("products", "d", id=2)
    for number in (1, 2, 3):
        shop.line(number, 1, product=number, unit_cost_at_order=None)
    bronze = shop.warehouse(spark)
    costed = ingest.snapshot_costs(bronze.changes("orderdetails"), bronze.changes("products"))
    found = {r.id: r.unit_cost_at_order for r in costed.collect()}
    assert {number: str(cost) for number, cost in found.items()} == {1: "77.00", 2: "None", 3: "60.00"}
