import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions.measures import UNIT_COLUMNS, sales_measures
from orderloom.functions.periods import month_of, week_of
from orderloom.plans import checks, gold, runs
from tests import shop
from tests.shop import rows

MEASURES = [*UNIT_COLUMNS.values(), "revenue_delivered", "distinct_orders"]
MARTS = {runs.DAILY: gold.DAY, runs.WEEKLY: gold.WEEK, runs.MONTHLY: gold.MONTH_START}


@pytest.mark.parametrize("case", list(shop.STATUS))
def test_order_status(built, case):
    order_id = shop.CASES[case][0]
    found = runs.order_statuses(built).where(F.col("order_id") == order_id).first()
    assert found.order_status == shop.STATUS[case]
    assert found.total_line_items == len(shop.CASES[case][2])


def test_order_without_lines_has_no_status_but_stays_in_silver(built):
    no_lines = shop.CASES["no lines"][0]
    assert runs.order_statuses(built).where(F.col("order_id") == no_lines).isEmpty()
    listed = checks.orders_without_items(built.read("silver_orders"), built.read("silver_order_items"))
    assert rows(listed, "order_id") == [(no_lines,)]


def test_status_view_is_the_same_and_derived(spark, built):
    view = spark.table("orders_gold.gold_vw_order_status")
    frame = runs.order_statuses(built)
    assert sorted(view.columns) == sorted(frame.columns)
    assert rows(view, *frame.columns) == rows(frame)


def test_dim_order_keeps_orders_without_lines(built):
    runs.publish_dim_order(built)
    stored = built.read(runs.DIM_ORDER)
    assert stored.count() == len(shop.CASES)
    assert stored.where("order_status IS NULL").count() == 1


def test_full_name_skips_a_missing_part(built):
    got = rows(built.read(runs.DIM_CUSTOMER), "customer_id", "full_name")
    assert got == [(1, "Ada Byron"), (2, "Hopper")]


def test_fact_uses_the_price_of_the_line(built):
    fact = built.read(runs.FACT)
    line = fact.where("order_item_id = 141").first()
    assert (line.unit_price, line.line_total) == (Decimal("21.00"), Decimal("42.00"))
    assert (line.sku, line.customer_id, line.order_month) == ("LAMP-B", 1, dt.date(2024, 3, 1))
    assert fact.count() == sum(len(c[2]) for c in shop.CASES.values())


@pytest.mark.parametrize("table, period", MARTS.items())
def test_marts_equal_an_aggregate_of_the_fact(built, table, period):
    """Also shows that distinct orders add up over days, as an order has one date."""
    start = {
        gold.DAY: F.to_date("order_date"),
        gold.WEEK: week_of("order_date"),
        gold.MONTH_START: month_of("order_date"),
    }[period]
    keys = [*gold.PRODUCT_COLUMNS, period]
    fact = built.read(runs.FACT)
    direct = fact.groupBy(*gold.PRODUCT_COLUMNS, start.alias(period)).agg(*sales_measures())
    assert rows(built.read(table), *keys, *MEASURES) == rows(direct, *keys, *MEASURES)


@pytest.mark.parametrize("table", list(MARTS))
def test_units_of_all_statuses_are_the_quantity_sold(built, table):
    total = sum((F.col(c) for c in UNIT_COLUMNS.values()), F.lit(0))
    in_mart = built.read(table).agg(F.sum(total)).first()[0]
    assert in_mart == built.read(runs.FACT).agg(F.sum("quantity")).first()[0]


def test_mart_row_without_deliveries_is_zero(built):
    april = built.read(runs.MONTHLY).where("month_start = DATE'2024-04-01' AND product_id = 1").first()
    assert (april.units_delivered, april.revenue_delivered, april.units_shipped) == (0, Decimal("0.00"), 1)
    assert april.distinct_orders == 1  # orders of every status count


def test_mart_types(built):
    types = dict(built.read(runs.MONTHLY).dtypes)
    assert types["units_delivered"] == types["distinct_orders"] == "bigint"
    assert types["revenue_delivered"] == "decimal(22,2)"
    assert types["month_start"] == "date"
    assert types["_refreshed_at"] == "timestamp"


def test_fresh_mart_agrees_with_fact_and_stale_one_does_not(built):
    monthly, fact = built.read(runs.MONTHLY), built.read(runs.FACT)
    assert checks.mart_vs_fact(monthly, fact).isEmpty()
    changed = fact.withColumn(
        "line_status", F.when(F.col("order_item_id") == 141, "RETURNED").otherwise(F.col("line_status"))
    )
    found = checks.mart_vs_fact(monthly, changed).collect()
    assert [(r.product_id, r.month_start, r.units_delivered_mart, r.units_delivered_fact) for r in found] == [
        (2, dt.date(2024, 3, 1), 2, 0)
    ]


def test_duplicate_natural_keys_are_reported(spark):
    customers = spark.sql("SELECT * FROM VALUES ('a@x'),('a@x'),('b@x') t(email)")
    products = spark.sql("SELECT * FROM VALUES ('S1'),('S2'),('S2'),('S2') t(sku)")
    got = rows(checks.duplicate_natural_keys(customers, products))
    assert got == [("email", "a@x", 2), ("sku", "S2", 3)]


def test_rebuild_twice_gives_the_same_rows(new_lake):
    lake = new_lake()
    shop.build(lake)
    first = [rows(lake.read(t).drop("_refreshed_at")) for t in (runs.FACT, *MARTS)]
    shop.build(lake)
    assert [rows(lake.read(t).drop("_refreshed_at")) for t in (runs.FACT, *MARTS)] == first


def test_flipping_one_line_moves_the_order(spark, new_lake):
    """The manual test of the model: DELIVERED to PENDING in Bronze, rebuild, look again."""
    lake = new_lake()
    shop.land(lake)
    flipped = [
        (*r[:5], "PENDING", *r[6:]) if r[0] == "102" else r for r in shop.item_rows()
    ]
    lake.publish("bronze_order_items", shop.bronze(spark, "bronze_order_items", flipped))
    runs.run_silver(lake)
    status = runs.order_statuses(lake).where("order_id = 10").first().order_status
    assert status == "PARTIALLY_SHIPPED"
