"""A tiny shop written as a change log, for scenario tests."""

from __future__ import annotations

import datetime as dt
import json
import tempfile
from collections import defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from cdcmart.operators.bronze import typed_bronze
from cdcmart.plans.warehouse import Warehouse
from cdcmart.sources.changes import read_changes, table_changes
from cdcmart.sources.specs import TABLES


def millis(*when: int) -> int:
    return int(dt.datetime(*when, tzinfo=dt.timezone.utc).timestamp() * 1000)


class Shop:
    def __init__(self):
        self.records: list[tuple[str, int, int, str]] = []
        self.next_offset: dict[str, int] = defaultdict(int)

    def change(self, table: str, op: str = "c", **fields) -> None:
        payload = {**fields, "__op": op, "__table": table, "__source_ts_ms": 1}
        self.raw(table, json.dumps(payload))

    def raw(self, table: str, payload: str) -> None:
        self.records.append((TABLES[table].topic, 0, self.next_offset[table], payload))
        self.next_offset[table] += 1

    def catalog(self) -> Shop:
        """Lookups, one customer, three products."""
        for number, name in enumerate(("pending", "confirmed", "shipping", " Delivered ", "cancelled"), 1):
            self.change("order_status", "r", id=number, order_status_name=name, created_at=0)
        self.change("regions", id=1, region_name="North", created_at=0)
        self.change("provinces", id=7, province_name=" Hanoi ", region_id=1, latitude="21.0", created_at=0)
        self.change("users", id=1, username=" ann ", created_at=millis(2024, 1, 1, 17))
        self.change("addresses", id=5, user_id=1, province_id=7, region_id=1, created_at=0)
        self.change("payment_methods", id=1, payment_method_name="COD", created_at=0)
        self.change("shipping_methods", id=1, shipping_method_name="Express", created_at=0)
        self.change("ads_campaigns", id=3, campaign_title=" Spring ")
        self.change("discounts", id=9, adscampaign_id=3, type="amount", value="10.00")
        self.change("brands", id=2, brand_name="Acme", created_at=0)
        self.change("categories", id=1, category_name="Home", created_at=0)
        self.change("categories", id=2, category_name="Lamps", category_id=1, created_at=0)
        for number in (1, 2, 3):
            self.change(
                "products", id=number, product_name=f"P{number}", category_id=2, brand_id=2,
                product_price="100.00", unit_cost="60.00", created_at=0,
            )
        return self

    def order(self, number: int, amount: str, discount: str, status: int = 4, op: str = "c", **more) -> None:
        fields = {
            "address_id": 5, "discount_id": 9, "payment_method_id": 1, "shipping_method_id": 1,
            "created_at": millis(2024, 1, 1, 17), "updated_at": millis(2024, 1, 1, 17), **more,
        }
        self.change(
            "orders", op, id=number, user_id=1, order_amount=amount, discount_amount=discount,
            total_amount="0.00", order_status_id=status, **fields,
        )

    def line(self, number: int, order: int, product: int = 1, price="100.00", subtotal="110.00", **more) -> None:
        fields = {"quantity": 1, "unit_cost_at_order": "60.00", "created_at": 0, **more}
        self.change(
            "orderdetails", id=number, order_id=order, product_id=product, product_price=price,
            product_tax="10.00", subtotal_amount=subtotal, **fields,
        )

    def log(self, spark: SparkSession, records=None) -> DataFrame:
        folder = tempfile.mkdtemp(prefix="shop-log-")
        names = ("topic", "partition", "offset", "payload")
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.string())
        columns = [pa.array(values, kind) for values, kind in zip(zip(*(records or self.records)), kinds)]
        pq.write_table(pa.table(dict(zip(names, columns))), f"{folder}/log.parquet")
        return read_changes(spark, folder, fmt="parquet")

    def warehouse(self, spark: SparkSession, records=None, **options) -> Warehouse:
        log = self.log(spark, records)
        bronze = {name: typed_bronze(table_changes(log, spec), spec) for name, spec in TABLES.items()}
        return Warehouse(spark, bronze, **options)
