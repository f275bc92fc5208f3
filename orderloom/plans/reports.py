"""Queries of the analysts: most sold products by period, order-status overviews.

"Sold" means delivered lines. Every query takes the day it is asked on (`as_of`); without
one it is today. Ties end with the SKU, so an answer is always the same row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.config import DELIVERED
from orderloom.functions import periods as p
from orderloom.operators.ranking import best_sellers
from orderloom.plans.gold import DAY, MONTH_START, WEEK
from orderloom.schemas import MONTH

_MART_COLUMNS = [
    "sku",
    "product_name",
    "category",
    "units_delivered",
    "revenue_delivered",
    "distinct_orders",
]


def _now(as_of: dt.date | None) -> dt.date:
    return as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _today(as_of: dt.date | None) -> dt.date:
    now = _now(as_of)
    return now.date() if isinstance(now, dt.datetime) else now


# ---- lookups in a mart ------------------------------------------------------------------


def _period(mart: DataFrame, column: str, start: dt.date) -> DataFrame:
    """One period of a mart; the daily mart is stored by month, so that is given as well."""
    rows = mart.where(F.col(column) == F.lit(start))
    if MONTH in mart.columns:
        rows = rows.where(F.col(MONTH) == F.lit(p.month_start(start)))
    return rows


def top_product_last_month(monthly: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    start, _ = p.previous_month(_today(as_of))
    rows = _period(monthly, MONTH_START, start).select(
        "product_id",
        "sku",
        "product_name",
        "category",
        F.col("units_delivered").alias("units_sold"),
        F.col("revenue_delivered").alias("revenue"),
        "distinct_orders",
    )
    return best_sellers(rows, "units_sold", "revenue", 1)


def top_product_last_week(weekly: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    rows = _period(weekly, WEEK, p.previous_week(_today(as_of))).select(*_MART_COLUMNS)
    return best_sellers(rows, "units_delivered", "revenue_delivered", 1)


def top_product_yesterday(daily: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    day = _today(as_of) - dt.timedelta(days=1)
    rows = _period(daily, DAY, day).select(*_MART_COLUMNS)
    return best_sellers(rows, "units_delivered", "revenue_delivered", 1)


def top_products_on_day(daily: DataFrame, day: dt.date, k: int = 5) -> DataFrame:
    rows = _period(daily, DAY, day).select(
        "sku", "product_name", "units_delivered", "revenue_delivered"
    )
    return best_sellers(rows, "units_delivered", "revenue_delivered", k)


# ---- computed from the fact -------------------------------------------------------------


def _delivered(fact: DataFrame, start: dt.date, end: dt.date | None = None) -> DataFrame:
    """Delivered lines of orders placed from `start` on, and before `end` if one is given.

    The fact is stored by month, and Spark does not derive a month from a date range; the
    months are therefore given too.
    """
    rows = fact.where(F.col("line_status") == DELIVERED)
    rows = rows.where(F.col("order_date") >= p.at(start))
    first_day = start.date() if isinstance(start, dt.datetime) else start
    rows = rows.where(F.col(MONTH) >= F.lit(p.month_start(first_day)))
    if end is not None:
        rows = rows.where(F.col("order_date") < p.at(end))
        rows = rows.where(F.col(MONTH) < F.lit(end))
    return rows


def _sold(lines: DataFrame, by: list[str]) -> DataFrame:
    totals = [F.sum("quantity").alias("units_sold"), F.sum("line_total").alias("revenue")]
    return lines.groupBy(*by).agg(*totals)


def top_product_last_month_from_fact(fact: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """As the mart lookup, but the distinct orders are those with a delivered line."""
    lines = _delivered(fact, *p.previous_month(_today(as_of)))
    # The names of a product come along as one value per group, not as grouping columns: the
    # exchanges of the distinct count are keyed by two numbers.
    per_order = lines.groupBy("product_id", "order_id").agg(
        F.sum("quantity").alias("units"),
        F.sum("line_total").alias("money"),
        F.first(F.struct("sku", "product_name", "category")).alias("names"),
    )
    sold = per_order.groupBy("product_id").agg(
        F.first("names").alias("names"),
        F.sum("units").alias("units_sold"),
        F.sum("money").alias("revenue"),
        F.count("*").alias("distinct_orders"),
    )
    sold = sold.select("product_id", "names.*", "units_sold", "revenue", "distinct_orders")
    return best_sellers(sold, "units_sold", "revenue", 1)


def leaderboard_last_month(fact: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    lines = _delivered(fact, *p.previous_month(_today(as_of)))
    return best_sellers(_sold(lines, ["sku", "product_name", "category"]), "units_sold", "revenue")


def top_product_trailing(
    fact: DataFrame, as_of: dt.date | None = None, days: int = 30
) -> DataFrame:
    """Winner of the last `days` days, to the second if `as_of` has a time of day.

    There is no upper bound: orders dated in the future count as well.
    """
    lines = _delivered(fact, _now(as_of) - dt.timedelta(days=days))
    return best_sellers(_sold(lines, ["sku", "product_name"]), "units_sold", "revenue", 1)


def top_product_by_revenue(fact: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    lines = _delivered(fact, *p.previous_month(_today(as_of)))
    sold = _sold(lines, ["sku", "product_name"]).select(
        "sku", "product_name", "revenue", "units_sold"
    )
    return best_sellers(sold, "revenue", "units_sold", 1)


# ---- order status -----------------------------------------------------------------------


def order_status_distribution(statuses: DataFrame) -> DataFrame:
    counted = statuses.groupBy("order_status").agg(F.count("*").alias("n_orders"))
    return counted.orderBy(F.col("n_orders").desc(), "order_status")


def orders_with_status(statuses: DataFrame, status: str, k: int = 5) -> DataFrame:
    """The first `k` orders of one status, by order id."""
    return statuses.where(F.col("order_status") == status).orderBy("order_id").limit(k)


def status_peek(statuses: DataFrame, wanted: list[str], k: int = 10) -> DataFrame:
    chosen = statuses.where(F.col("order_status").isin(*wanted))
    return chosen.orderBy("order_status", "order_id").limit(k)
