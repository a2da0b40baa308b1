import datetime as dt
import time

import pytest
from conftest import rows
from shop import Shop, millis

from cdcmart.operators.bronze import typed_bronze
from cdcmart.plans.maintained import FACTS, MaintainedFacts
from cdcmart.sources.base import Store
from cdcmart.sources.changes import table_changes
from cdcmart.sources.specs import TABLES


@pytest.fixture
def facts(spark, tmp_path):
    made = MaintainedFacts(spark, str(tmp_path / "facts"), buckets=8)
    yield made
    made.discard()


def changes(spark, shop, since=0):
    log = shop.log(spark, shop.records[since:])
    names = {topic: name for name, topic in ((n, s.topic) for n, s in TABLES.items())}
    told = {names[topic] for topic, *_ in shop.records[since:]}
    return {name: typed_bronze(table_changes(log, TABLES[name]), TABLES[name]) for name in told}


def same(spark, facts, shop):
    whole = shop.warehouse(spark)
    for name in FACTS:
        want = getattr(whole, name)()
        assert rows(getattr(facts, name)().select(*want.columns)) == rows(want), name


def test_facts_follow_the_changes(spark, facts):
    shop = Shop().catalog()
    for order in range(1, 31):
        shop.order(order, "220.00", "10.00", status=4 if order % 3 else 1)
        shop.line(order * 10, order, product=1 + order % 3)
        shop.line(order * 10 + 1, order, product=2, unit_cost_at_order=None if order == 4 else "60.00")
    facts.apply(changes(spark, shop), 0)
    same(spark, facts, shop)
    at = len(shop.records)
    # An order is cancelled, one is delivered late, one loses a line, one is deleted, one moves to another day.
    shop.order(1, "220.00", "10.00", status=5, op="u")
    shop.order(3, "220.00", "10.00", status=4, op="u")
    shop.line(41, 4, product=2, __deleted="true")
    shop.change("orders", "d", id=7, __deleted="true")
    shop.order(8, "220.00", "12.00", op="u", created_at=millis(2024, 2, 2))
    shop.line(89, 8, product=3)
    facts.apply(changes(spark, shop, at), 1)
    same(spark, facts, shop)
    # What orders refer to changes: the address moves; a user registers, one leaves.
    at = len(shop.records)
    shop.change("addresses", "u", id=5, user_id=1, province_id=8, region_id=1, created_at=0)
    shop.change("users", "d", id=1, __deleted="true")
    shop.change("users", id=2, username="bob", created_at=millis(2024, 3, 1))
    facts.apply(changes(spark, shop, at), 2)
    same(spark, facts, shop)
    # No status is named delivered any more: the sales fact is left without a row.
    at = len(shop.records)
    shop.change("order_status", "u", id=4, order_status_name="lost", created_at=0)
    facts.apply(changes(spark, shop, at), 3)
    assert rows(facts.fact_sales_product()) == []
    same(spark, facts, shop)


def test_a_small_batch_reads_and_writes_few_buckets(spark, facts, monkeypatch):
    shop = Shop().catalog()
    for order in range(1, 60):
        shop.order(order, "110.00", "10.00")
        shop.line(order * 10, order, product=1 + order % 3)
    facts.apply(changes(spark, shop), 0)
    read = []
    plain = Store.read

    def watched(self, **which):
        read.append((self.path.rsplit("/", 1)[1], which.get("slots")))
        return plain(self, **which)

    monkeypatch.setattr(Store, "read", watched)
    at = len(shop.records)
    shop.order(5, "110.00", "11.00", op="u")
    facts.apply(changes(spark, shop, at), 1)
    assert all(len(slots) == 1 for table, slots in read if table in ("orders", "orderdetails"))
    assert {table for table, _ in read} >= {"orders", "orderdetails"}
    lines = facts.tables["orderdetails"]
    assert lines.manifest(0) == lines.manifest(max(lines.versions())) and len(lines.versions()) == 1
    orders = facts.tables["orders"]
    assert len([s for s in orders.manifest(0) if orders.manifest(0)[s] != orders.manifest(1)[s]]) == 1
    monkeypatch.undo()
    same(spark, facts, shop)


def test_a_batch_that_failed_is_applied_again(spark, facts, monkeypatch):
    shop = Shop().catalog()
    shop.order(1, "110.00", "10.00")
    shop.line(10, 1)
    facts.apply(changes(spark, shop), 0)
    at = len(shop.records)
    shop.order(1, "110.00", "20.00", op="u")
    batch = changes(spark, shop, at)
    plain = MaintainedFacts._merge

    def fails(self, name, *rest):
        if name == "fact_order_overview":
            raise OSError("lost")
        return plain(self, name, *rest)

    monkeypatch.setattr(MaintainedFacts, "_merge", fails)
    with pytest.raises(OSError):
        facts.apply(batch, 1)
    monkeypatch.undo()
    facts.apply(batch, 1)
    facts.apply(batch, 1)
    same(spark, facts, shop)


def test_batches_leave_no_shuffle_files_no_copies_and_no_old_rows(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))

    path = tmp_path / "facts"
    facts = MaintainedFacts(spark, str(path), ["fact_order_overview"], buckets=4)
    shop = Shop().catalog()
    for order in range(1, 9):
        shop.order(order, "220.00", "10.00", status=4)
    at, before = len(shop.records), shuffled()
    facts.apply(changes(spark, shop), 0)
    for order in range(1, 9):
        shop.order(order, "230.00", "10.00", status=4, op="u")
    facts.apply(changes(spark, shop, at), 1)
    for _ in range(50):  # they go in the background
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
    assert sorted(x.name for x in path.iterdir()) == ["facts", "tables"]
    facts.drop_unreferenced(1, dt.datetime.now() + dt.timedelta(hours=1))
    assert len(list((path / "tables/orders/files").iterdir())) == 1
    facts.apply(changes(spark, shop, at), 1)  # again: nothing is counted twice
    want = shop.warehouse(spark).fact_order_overview()
    assert rows(facts.fact_order_overview().select(*want.columns)) == rows(want)
    facts.discard()
