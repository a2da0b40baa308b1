"""Lines that are numbered within their order: another order may hold a line of the same id."""

import os

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from conftest import SAMPLE_FOLDER

from checks.compare import TABLES, connect, differences
from cdcmart.operators import skew

OF_LINES = [
    "silver_order_items", "sales_line_base", "sales_line_preliminary", "sales_line_allocated", "sales_line_measured",
    "fact_sales_product", "discount_conservation", "distinct_orders", "fact_validation", "report_delivered_order_aov",
    "report_marketing_dashboard", "report_overview_sales", "report_overview_sales_base", "maintained_fact_sales_product",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """The sample, every fifth of its lines in a second order as well."""
    path = tmp_path_factory.mktemp("lines")
    for table in TABLES:
        if table != "lineitem":
            os.symlink(f"{SAMPLE_FOLDER}/{table}.parquet", path / f"{table}.parquet")
    lines = pq.read_table(f"{SAMPLE_FOLDER}/lineitem.parquet")
    some = lines.take(pa.array(range(0, len(lines), 5)))
    orders = pq.read_metadata(f"{SAMPLE_FOLDER}/orders.parquet").num_rows
    other = pc.add(some["l_orderkey"], 7)
    other = pc.if_else(pc.less(other, orders), other, pc.subtract(other, orders))
    again = some.set_column(some.schema.get_field_index("l_orderkey"), "l_orderkey", other)
    pq.write_table(pa.concat_tables([lines, again]), path / "lineitem.parquet")
    return str(path)


@pytest.mark.parametrize("name", OF_LINES)
def test_equal_ids_in_several_orders(spark, folder, name):
    assert differences(spark, connect(folder), folder, name) is None


def test_equal_ids_in_hot_orders(spark, folder, crowded):
    assert skew.SAMPLE == 1
    assert differences(spark, connect(folder), folder, "sales_line_measured") is None
