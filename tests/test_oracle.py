"""Every registered query against its SQL on the smallest sample."""

import pytest
from conftest import SAMPLE_FOLDER

from checks.compare import connect, frame_differences
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return connect(SAMPLE_FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    frame = QUERIES[name](spark, SAMPLE_FOLDER)
    assert frame_differences(frame, connection, name) is None
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan, "row work left the JVM"
    assert "Join Cross" not in plan


def test_entry(spark):
    import __spark_entry__

    frame = __spark_entry__.entry(spark)
    assert frame.columns == ["date", "city_id", "delivered_order_count", "gmv_ex_vat", "net_sales_ex_vat", "aov_ex_vat"]
    assert frame.count() > 0
