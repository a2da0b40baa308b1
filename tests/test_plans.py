"""Physical plans: what is read, what is moved, what is repeated."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cdcmart import session
from cdcmart.operators.bronze import typed_bronze
from cdcmart.operators.quarantine import quarantine
from cdcmart.operators.state import current_state
from cdcmart.plans import gold
from cdcmart.plans.warehouse import Warehouse
from cdcmart.sources.changes import capture_raw
from cdcmart.sources.specs import BY_ORDER, TABLES


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def unbroadcast(spark):
    """Plans as for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def change_table(spark, tmp_path, sample):
    path = str(tmp_path / "orders")
    sample.order_log().write.parquet(path)
    return spark.read.parquet(path)


def test_versions_are_thinned_out_before_the_shuffle(change_table):
    plan = physical(current_state(change_table))
    final, partial = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_key_filter_reaches_the_scan_and_tombstone_filter_does_not(change_table):
    plan = physical(current_state(change_table).where("id = 5"))
    assert "EqualTo(id,5)" in plan and "EqualTo(_deleted,0)" not in plan


def compacted(spark, sample, tmp_path, **options):
    """The order tables as compacted files, the rest straight from the sample."""
    tables = dict(sample.tables())
    for name in ("orders", "orderdetails"):
        path = str(tmp_path / f"compacted-{name}")
        tables[name]().write.parquet(path)
        tables[name] = spark.read.parquet(path)
    return Warehouse(spark, tables, compacted=tables, **options)


def test_day_range_reaches_the_scan(spark, sample, tmp_path):
    day = dt.date(1996, 5, 1)
    plan = physical(compacted(spark, sample, tmp_path, days=(day, day)).fact_sales_product())
    # Local midnight is 17:00 UTC of the day before.
    pushed = re.search(r"compacted-orders\].*?PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(created_at,1996-04-30" in pushed and "LessThan(created_at,1996-05-01" in pushed


def test_day_range_reaches_the_base_of_changing_tables(spark, sample, tmp_path, unbroadcast):
    """Tables that are a compacted base and changes since: the base is pruned by the range, and
    only the changes and the base's rows of changed keys are ranked by version."""
    day, tables, base = dt.date(1996, 5, 1), {}, {}
    for name in sample.tables():
        tables[name] = sample.history(name).where("pmod(xxhash64(id), 7) = 0")
    for name in ("orders", "orderdetails"):
        path = str(tmp_path / f"base-{name}")
        sample._table(name).write.parquet(path)
        base[name] = spark.read.parquet(path)
        tables[name].write.parquet(path + "-changes")
        tables[name] = spark.read.parquet(path + "-changes")
    rest = {name: table for name, table in sample.tables().items() if name not in base}
    warehouse = Warehouse(spark, tables | rest, base=base, compacted=rest, days=(day, day))
    plan = physical(warehouse.fact_sales_product())
    pushed = re.findall(r"base-orders\].*?PushedFilters: \[(.*?)\]", plan)
    assert any("GreaterThanOrEqual(created_at,1996-04-30" in x and "LessThan(created_at,1996-05-01" in x for x in pushed)


def test_facts_read_only_their_columns(spark, sample, tmp_path):
    plan = physical(compacted(spark, sample, tmp_path).fact_order_overview())
    read = re.search(r"compacted-orders\].*?ReadSchema: struct<(.*?)>", plan).group(1)
    assert "shipped_at" not in read and "staff_id" not in read and "total_amount" in read


def test_sale_lines_move_once(spark, sample, tmp_path, unbroadcast):
    """Join and allocation windows share one partitioning by order."""
    plan = physical(compacted(spark, sample, tmp_path).sales_line_measured(ranked=False))
    window, join = plan.index("Window ["), plan.index("SortMergeJoin [order_id")
    assert window < join
    assert "Exchange" not in plan[window:join]
    assert plan.count("Window [") == 1 and "row_number" not in plan


def test_date_filter_passes_the_window(spark, sample, tmp_path):
    measured = compacted(spark, sample, tmp_path).sales_line_measured(ranked=False)
    plan = optimized(measured.where(F.col("date_key") == F.lit(dt.date(1996, 5, 1))))
    window = plan.index("Window [")
    assert "Filter" not in plan[:window] and "1996-05-01" in plan[window:]


def test_lookup_fallback_spreads_without_repeating_the_lookup_chain(spark, sample, tmp_path, crowded):
    """Hot keys are searched in the base table: the orders are read three times (work and
    two searches), not once per combination of joins."""
    warehouse = compacted(spark, sample, tmp_path)
    plan = optimized(warehouse.orders())
    assert plan.count("_spread") > 0
    assert physical(warehouse.orders()).count("compacted-orders]") == 3


def test_undelivered_orders_are_dropped_before_lookups(spark, sample, tmp_path, unbroadcast):
    plan = optimized(compacted(spark, sample, tmp_path).sale_heads())
    assert plan.index("LeftOuter") < plan.index("Inner")


def test_payload_is_parsed_once(spark, sample):
    log = sample.event_log()
    assert optimized(typed_bronze(log, TABLES["orderdetails"])).count("from_json") == 1
    assert optimized(quarantine(capture_raw(log))).count("MapType") <= 1


def test_calendar_is_broadcast_and_small(spark, sample, unbroadcast):
    warehouse = Warehouse(spark, sample.tables(), compacted=sample.tables())
    assert "BroadcastHashJoin [date_key" in physical(warehouse.report_overview_orders())
    assert gold.CALENDAR_DAYS == 36525


def test_hot_orders_are_divided_before_versions_are_compared(spark, sample, unbroadcast):
    """With lines keyed by their order, what depends on hot orders reads nothing before these are known."""
    plan = optimized(Warehouse(spark, sample.histories(), keys=BY_ORDER).sales_line_allocated()).splitlines()
    joins = [i for i, line in enumerate(plan) if ("Join LeftSemi" in line or "Join LeftAnti" in line) and "_k0" not in line]
    assert len(joins) >= 4  # lookups have their own, by _k0
    for at in joins:
        column = plan[at].index("Join")
        left = []
        for line in plan[at + 1 :]:
            if line[column : column + 1] != ":":
                break
            left.append(line)
        assert left and not any("Window" in line for line in left)


def test_scan_parts_are_bounded(spark):
    before = spark.conf.get(session.SCAN_PART)
    for given, left in (("128m", session.SCAN_BYTES), ("134217728b", session.SCAN_BYTES), ("1m", 1 << 20)):
        spark.conf.set(session.SCAN_PART, given)
        assert session.size_bytes(session.configure(spark).conf.get(session.SCAN_PART)) == left
    spark.conf.set(session.SCAN_PART, before)
