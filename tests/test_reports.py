import datetime as dt
from decimal import Decimal

import pytest

from orderloom.plans import reports, runs

D = dt.date
APRIL = D(2024, 4, 15)  # "last month" is March


def sku(df):
    found = [r.sku for r in df.collect()]
    return found[0] if found else None


def march_fact(spark, extra=()):
    lines = [
        # sku, ordered at, status, quantity, total
        ("A", "2024-02-29 23:59:59", "DELIVERED", 50, 500),
        ("A", "2024-03-01 00:00:00", "DELIVERED", 5, 50),
        ("B", "2024-03-31 23:59:59", "DELIVERED", 5, 60),
        ("C", "2024-03-15 00:00:00", "DELIVERED", 4, 900),
        ("C", "2024-03-15 00:00:00", "PENDING", 40, 9000),
        ("D", "2024-04-01 00:00:00", "DELIVERED", 99, 990),
        ("E", "2024-03-09 00:00:00", "DELIVERED", 5, 60),
        ("F", "2024-09-01 00:00:00", "DELIVERED", 70, 700),
        *extra,
    ]
    df = spark.createDataFrame(lines, "sku string, at string, line_status string, quantity int, total int")
    return df.selectExpr(
        "hash(sku) product_id", "sku", "'n' product_name", "'c' category",
        "cast(at AS timestamp) order_date", "trunc(cast(at AS date), 'MM') order_month",
        "line_status", "quantity", "cast(total AS decimal(12,2)) line_total",
        "hash(sku, at) order_id",
    )


def test_last_month_is_half_open_and_ties_end_with_revenue_then_sku(spark):
    fact = march_fact(spark)
    board = reports.leaderboard_last_month(fact, APRIL).collect()
    assert [(r.sku, r.units_sold) for r in board] == [("B", 5), ("E", 5), ("A", 5), ("C", 4)]
    top = reports.top_product_last_month_from_fact(fact, APRIL).collect()
    assert [(r.sku, r.units_sold, r.revenue, r.distinct_orders) for r in top] == [
        ("B", 5, Decimal("60.00"), 1)
    ]


def test_by_revenue(spark):
    best = reports.top_product_by_revenue(march_fact(spark), APRIL)
    assert best.columns == ["sku", "product_name", "revenue", "units_sold"]
    assert sku(best) == "C"


def test_trailing_days_have_no_upper_bound(spark):
    assert sku(reports.top_product_trailing(march_fact(spark), APRIL)) == "D"
    later = reports.top_product_trailing(march_fact(spark), D(2024, 6, 1))
    assert sku(later) == "F"


def test_trailing_days_count_to_the_second(spark):
    fact = march_fact(spark, [("G", "2024-08-02 10:00:00", "DELIVERED", 500, 1)])
    at = dt.datetime(2024, 9, 1, 10, 0, 0)
    assert sku(reports.top_product_trailing(fact, at)) == "G"
    assert sku(reports.top_product_trailing(fact, at + dt.timedelta(seconds=1))) == "F"


def test_without_a_day_the_reports_ask_about_today(spark):
    today = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    last_month = (today.replace(day=1) - dt.timedelta(days=1)).strftime("%Y-%m-%d 12:00:00")
    fact = march_fact(spark, [("NOW", last_month, "DELIVERED", 1, 1)])
    assert sku(reports.top_product_last_month_from_fact(fact)) == "NOW"


def test_mart_lookups(built):
    monthly, weekly, daily = (built.read(t) for t in (runs.MONTHLY, runs.WEEKLY, runs.DAILY))
    top = reports.top_product_last_month(monthly, APRIL).first()
    assert (top.sku, top.units_sold, top.revenue) == ("LAMP-B", 2, Decimal("42.00"))
    assert sku(reports.top_product_last_week(weekly, D(2024, 3, 11))) == "LAMP-B"
    assert sku(reports.top_product_last_week(weekly, D(2024, 3, 10))) == "LAMP-A"  # ends on Sunday
    assert sku(reports.top_product_yesterday(daily, D(2024, 3, 1))) == "LAMP-A"
    assert sku(reports.top_product_yesterday(daily, D(2024, 6, 1))) is None
    board = reports.top_products_on_day(daily, D(2024, 2, 29)).collect()
    assert [(r.sku, r.units_delivered) for r in board] == [("LAMP-A", 2), ("LAMP-B", 1)]


def test_period_without_deliveries(built):
    """The mart has a row of zeros for it, the fact query has none."""
    may = D(2024, 5, 2)
    assert reports.top_product_last_month(built.read(runs.MONTHLY), may).first().units_sold == 0
    assert reports.top_product_last_month_from_fact(built.read(runs.FACT), may).isEmpty()


def test_mart_and_fact_name_the_same_product(built):
    a = reports.top_product_last_month(built.read(runs.MONTHLY), APRIL).first()
    b = reports.top_product_last_month_from_fact(built.read(runs.FACT), APRIL).first()
    assert a.asDict().keys() == b.asDict().keys()
    assert (a.sku, a.units_sold, a.revenue) == (b.sku, b.units_sold, b.revenue)


@pytest.fixture(scope="module")
def statuses(built):
    return runs.order_statuses(built)


def test_status_distribution(statuses):
    got = [(r.order_status, r.n_orders) for r in reports.order_status_distribution(statuses).collect()]
    assert got == [
        ("COMPLETED", 3), ("PARTIALLY_SHIPPED", 3), ("IN_PROGRESS", 2), ("CANCELLED", 1), ("PENDING", 1),
    ]


def test_status_samples(statuses):
    done = reports.orders_with_status(statuses, "COMPLETED", 2).collect()
    assert [r.order_id for r in done] == [10, 19]
    peek = reports.status_peek(statuses, ["COMPLETED", "PARTIALLY_SHIPPED"], 4).collect()
    assert [(r.order_status, r.order_id) for r in peek] == [
        ("COMPLETED", 10), ("COMPLETED", 19), ("COMPLETED", 20), ("PARTIALLY_SHIPPED", 13),
    ]
