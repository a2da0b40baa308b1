"""Change logs followed from the wire to the reports; expected values worked out by hand."""

import datetime as dt
import random
from decimal import Decimal as D

from conftest import rows
from pyspark.sql import functions as F
from shop import Shop, millis

from cdcmart.operators.state import current_state

REPORTS = ("fact_order_overview", "fact_sales_product")


def gross_and_net(warehouse):
    measured = warehouse.sales_line_measured().orderBy("order_item_id")
    return [(r.discount_gross, r.discount_ex_vat) for r in measured.collect()]


def three_lines():
    shop = Shop().catalog()
    shop.order(1, "330.00", "10.00")
    for number in (1, 2, 3):
        shop.line(number, 1, product=number)
    return shop


def test_replay_and_arrival_order_change_nothing(spark):
    shop = three_lines()
    shop.order(1, "330.00", "10.00", op="u", status=4)
    expected = [rows(getattr(shop.warehouse(spark), name)()) for name in REPORTS]
    shuffled = shop.records * 2
    random.Random(4).shuffle(shuffled)
    replayed = shop.warehouse(spark, shuffled)
    assert [rows(getattr(replayed, name)()) for name in REPORTS] == expected


def test_deleted_order_leaves_a_tombstone_only(spark):
    shop = three_lines()
    shop.order(1, "330.00", "10.00", op="u")
    shop.change("orders", "d", id=1, __deleted="true")
    warehouse = shop.warehouse(spark)
    assert warehouse.orders().count() == 0
    assert warehouse.fact_sales_product().count() == 0
    audit = current_state(warehouse.changes("orders"), include_deleted=True).collect()
    assert [(r.id, r._version, r._deleted) for r in audit] == [(1, 2, 1)]


def test_key_inserted_again_after_delete(spark):
    shop = Shop().catalog()
    shop.order(1, "1.00", "0.00")
    shop.change("orders", "d", id=1)
    shop.order(1, "2.00", "0.00")
    assert [r.order_amount for r in shop.warehouse(spark).orders().collect()] == [D("2.00")]


def test_order_counts_in_one_status_at_a_time(spark):
    shop = three_lines()
    seen = []
    for status in (3, 4, 5):
        shop.order(1, "330.00", "10.00", status=status, op="u")
        warehouse = shop.warehouse(spark)
        buckets = [(r.order_status_id, r.order_count) for r in warehouse.fact_order_overview().collect()]
        seen.append((buckets, warehouse.fact_sales_product().count()))
    assert seen == [([(3, 1)], 0), ([(4, 1)], 3), ([(5, 1)], 0)]


def test_late_line_moves_the_remainder(spark):
    shop = Shop().catalog()
    shop.order(1, "330.00", "10.00")
    shop.line(1, 1)
    shop.line(2, 1)
    before = [gross for gross, _ in gross_and_net(shop.warehouse(spark))]
    shop.line(3, 1)
    warehouse = shop.warehouse(spark)
    assert before == [D("3.33"), D("6.67")]
    assert [gross for gross, _ in gross_and_net(warehouse)] == [D("3.33"), D("3.33"), D("3.34")]
    assert tuple(warehouse.discount_conservation().first()) == (1, 0, D("10.00"))


def test_discount_of_three_equal_lines(spark):
    warehouse = three_lines().warehouse(spark)
    assert gross_and_net(warehouse) == [(D("3.33"), D("3.03")), (D("3.33"), D("3.03")), (D("3.34"), D("3.04"))]
    assert warehouse.report_delivered_order_aov().first().net_sales_ex_vat == D("290.90")


def test_negative_remainder(spark):
    shop = Shop().catalog()
    shop.order(1, "440.00", "0.02")
    for number in range(1, 5):
        shop.line(number, 1)
    cent = (D("0.01"), D("0.01"))
    assert gross_and_net(shop.warehouse(spark)) == [cent, cent, cent, (D("-0.01"), D("-0.01"))]


def test_order_without_amount_gives_all_to_the_last_line(spark):
    shop = Shop().catalog()
    shop.order(1, "0.00", "5.00")
    shop.line(1, 1)
    shop.line(2, 1)
    assert [gross for gross, _ in gross_and_net(shop.warehouse(spark))] == [D("0.00"), D("5.00")]


def test_line_without_subtotal_has_no_discount_before_tax(spark):
    shop = Shop().catalog()
    shop.order(1, "110.00", "5.00")
    shop.line(1, 1, subtotal="0.00")
    assert gross_and_net(shop.warehouse(spark)) == [(D("5.00"), D("0.00"))]


def test_unknown_cost_hides_the_total(spark):
    shop = Shop().catalog()
    shop.order(1, "220.00", "0.00")
    shop.line(1, 1)
    shop.line(2, 1, unit_cost_at_order=None)
    fact = shop.warehouse(spark).fact_sales_product().first()
    assert (fact.total_cost, fact.unknown_cost_line_count, fact.gmv) == (None, 1, D("200.00"))


def test_order_counts_are_not_additive(spark):
    warehouse = three_lines().warehouse(spark)
    assert [r.order_count for r in warehouse.fact_sales_product().collect()] == [1, 1, 1]
    assert warehouse.report_delivered_order_aov().first().delivered_order_count == 1


def test_business_date_is_local(spark):
    warehouse = three_lines().warehouse(spark)
    assert warehouse.users().first().registration_date == dt.date(2024, 1, 2)
    assert warehouse.fact_order_overview().first().date_key == dt.date(2024, 1, 2)


def test_day_range_equals_filtering_the_report(spark):
    shop = three_lines()
    shop.order(2, "110.00", "0.00", created_at=millis(2024, 1, 1, 16, 59, 59))
    shop.line(4, 2)
    whole = shop.warehouse(spark).fact_sales_product()
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 2)):
        part = shop.warehouse(spark, days=(day, day)).fact_sales_product()
        assert rows(part) == rows(whole.where(F.col("date_key") == F.lit(day))) != []


def test_missing_references_get_defaults(spark):
    shop = Shop().catalog()
    shop.order(1, "1.00", "0.00", address_id=None, discount_id=None, payment_method_id=None, shipping_method_id=8)
    order = shop.warehouse(spark).orders().first()
    assert (order.city_id, order.campaign_key) == (0, 0)
    assert (order.payment_method, order.shipping_method) == ("Unknown", "Unknown")


def test_unknown_status_counts_in_the_overview_but_not_in_sales(spark):
    shop = Shop().catalog()
    shop.order(1, "110.00", "0.00", status=None)
    shop.line(1, 1)
    warehouse = shop.warehouse(spark)
    assert [r.order_status_id for r in warehouse.fact_order_overview().collect()] == [0]
    assert warehouse.fact_sales_product().count() == 0


def test_product_directly_below_a_root_category(spark):
    shop = Shop().catalog()
    shop.change("products", id=4, product_name="P4", category_id=1, product_price="abc", created_at=0)
    product = shop.warehouse(spark).products().where("product_id = 4").first()
    assert (product.subcategory_name, product.category_name, product.category_id) == ("Home", "Unknown", 0)
    assert (product.brand_id, product.brand_name, product.current_price) == (0, "Unknown", D("0.00"))


def test_text_is_trimmed(spark):
    warehouse = Shop().catalog().warehouse(spark)
    assert warehouse.users().first().username == "ann"
    assert [tuple(r)[:4] for r in warehouse.locations().collect()] == [(7, "Hanoi", 1, "North")]
    assert warehouse.campaigns().first().campaign_title == "Spring"


def test_marketing_report_row(spark):
    report = three_lines().warehouse(spark).report_marketing_dashboard().where("product_id = 3").first()
    assert (report.date, report.month, report.quarter, report.year) == (dt.date(2024, 1, 2), 1, 1, 2024)
    assert (report.province, report.region, report.campaign_title) == ("Hanoi", "North", "Spring")
    assert (report.parent_category, report.subcategory) == ("Home", "Lamps")
    assert (report.total_net_revenue, report.product_aov_ex_vat) == (D("96.96"), D("96.96000000"))
    assert report.avg_product_price == D("100.0000")


def test_calendar(spark):
    dates = Shop().catalog().warehouse(spark).dim_date()
    assert dates.count() == 36525
    assert dates.agg(F.max("date_key")).first()[0] == dt.date(2099, 12, 31)
    saturday = dates.where("date_key = date'2024-01-06'").first()
    assert (saturday.day_of_week, saturday.is_weekend) == (6, 1)


def test_views_and_published_reports(spark, tmp_path):
    from cdcmart.sources.log import read_published

    warehouse = three_lines().warehouse(spark)
    warehouse.share_sale_lines()
    assert warehouse.publish_reports(str(tmp_path), 1) and not warehouse.publish_reports(str(tmp_path), 1)
    for name in warehouse.register_views():
        assert rows(spark.table(name)) == rows(read_published(spark, str(tmp_path), name))
    assert spark.sql("select sum(total_gmv) from report_overview_sales").first()[0] == D("300.00")
