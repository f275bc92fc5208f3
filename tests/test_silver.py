import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.operators.integrity import REASON
from orderloom.plans import runs, silver
from orderloom.schemas import INGEST_TS, SILVER, contract
from tests import shop
from tests.shop import rows


def test_tables_have_the_declared_shape(built):
    for table, schema in SILVER.items():
        got = contract(built.read(table), table)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schema]
        for f in schema:
            if not f.nullable:
                assert got.where(F.col(f.name).isNull()).isEmpty()


def test_customers_are_typed_and_newest(built):
    got = rows(built.read("silver_customers"), "customer_id", "email", "phone")
    assert got == [(1, "ada@shop.test", None), (2, "grace@shop.test", "556")]


def test_products(built):
    got = rows(built.read("silver_products"), "product_id", "sku", "unit_price", "created_at")
    jan = dt.datetime(2023, 1, 1)
    assert got == [
        (1, "LAMP-A", Decimal("10.01"), jan),
        (2, "LAMP-B", Decimal("20.00"), None),  # an unreadable date is not worth the row
        (3, "RUG-C", None, jan),
    ]


def test_orders_without_customer_or_key_are_rejected(built):
    ids = [r[0] for r in rows(built.read("silver_orders"), "order_id")]
    assert ids == [c[0] for c in shop.CASES.values()]
    reasons = rows(runs.quarantine(built, "silver_orders").groupBy(REASON).count())
    assert reasons == [("bad_number", 1), ("null_key", 1), ("orphan_customer", 1)]


def test_one_spelling_of_a_key_is_one_row(built):
    line = built.read("silver_order_items").where("order_item_id = 101").collect()
    assert len(line) == 1
    assert line[0].line_status == "DELIVERED"
    assert str(line[0]._updated_ts) == shop.T1


def test_broken_items_are_rejected_with_their_reason(built):
    found = runs.quarantine(built, "silver_order_items").groupBy(REASON).count()
    assert dict(rows(found)) == shop.BROKEN_REASONS


def test_quarantine_holds_rows_as_they_landed(built):
    kept = runs.quarantine(built, "silver_order_items").where("order_item_id = '902'").first()
    assert (kept.unit_price, kept.line_status, kept.quantity) == ("ten", "PENDING", "1")


@pytest.mark.parametrize("table", list(SILVER))
def test_silver_and_quarantine_are_all_of_bronze(built, table):
    """No key is lost: every landed row is either in Silver, superseded there, or rejected."""
    bronze = built.read(table.replace("silver", "bronze"))
    key = SILVER[table].names[0]
    landed = bronze.select(F.col(key).try_cast("bigint").alias(key), INGEST_TS).collect()
    good = {r[0] for r in built.read(table).select(key).collect()}
    bad = runs.quarantine(built, table).count()
    assert len({r[0] for r in landed if r[0] is not None} - good) + len([1 for r in landed if r[0] is None]) == bad


def test_missing_quantity_is_kept_malformed_is_not(spark, built):
    landed = shop.bronze(
        spark,
        "bronze_order_items",
        [("1", "10", "1", None, "10.00", "PENDING", shop.T0, shop.T0), ("2", "10", "1", "?", "10.00", "PENDING", shop.T0, shop.T0)],
    )
    out = silver.silver_order_items(landed, built.read("silver_orders"), built.read("silver_products"))
    assert rows(out, "order_item_id", "quantity", "line_total") == [(1, None, None)]


def test_works_with_and_without_ansi_mode(spark, built):
    landed = shop.bronze(spark, "bronze_order_items")
    parents = built.read("silver_orders"), built.read("silver_products")
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        results = []
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            results.append(rows(silver.silver_order_items(landed, *parents)))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert results[0] == results[1]
