"""Silver to Gold: dimensions, the line-grain fact, sales marts, derived order status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.cleaning import full_name
from orderloom.functions.measures import (
    MEASURES,
    rolled_up_measures,
    sales_measures,
)
from orderloom.functions.periods import day_of, month_of, week_of
from orderloom.operators.dealing import add_up_by_folder, as_stored
from orderloom.schemas import MONTH
from orderloom.session import broadcasts

PRODUCT_COLUMNS = ["product_id", "sku", "product_name", "category"]
DAY, WEEK, MONTH_START = "order_day", "week_start", "month_start"


# ---- star schema ------------------------------------------------------------------------


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "first_name",
        "last_name",
        full_name("first_name", "last_name").alias("full_name"),
        "email",
        "phone",
        F.col("created_at").alias("customer_since"),
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        *PRODUCT_COLUMNS,
        F.col("unit_price").alias("current_list_price"),
        F.col("created_at").alias("product_introduced_at"),
    )


def fact_order_items(items: DataFrame, orders: DataFrame, products: DataFrame, dealt: bool = False) -> DataFrame:
    """One row per line with its order's date and its product's names.

    Orders and products are unique by key, so the joins keep the grain. No join hint: the
    product side is broadcast where its size allows it and shuffled where it does not. Lines
    are stored under the month of their order: where both sides have it, it is a key of the
    join, so that a filter on the months of one side prunes the other as well. With `dealt` the
    lines are shuffled to their months before the names, which are broadcast then, widen them.
    """
    by_month = MONTH in items.columns and MONTH in orders.columns
    month = [F.col(MONTH).alias("_month")] if by_month else []
    order_facts = orders.select(F.col("order_id").alias("_order"), "customer_id", "order_date", *month)
    same = F.col("_order") == F.col("order_id")
    if by_month:
        same = same & F.col("_month").eqNullSafe(F.col(MONTH))
    names = products.select(*PRODUCT_COLUMNS)
    lines = items.join(order_facts, same).drop(MONTH, "_month", "_order").withColumn(MONTH, month_of("order_date"))
    lines = as_stored(lines, MONTH).join(F.broadcast(names), "product_id") if dealt else lines.join(names, "product_id")
    return lines.select(
        "order_item_id",
        "order_id",
        "customer_id",
        *PRODUCT_COLUMNS,
        "order_date",
        MONTH,
        "quantity",
        "unit_price",
        "line_total",
        "line_status",
        "status_updated_at",
    )


# ---- sales marts ------------------------------------------------------------------------


def sales_by_day(fact: DataFrame) -> DataFrame:
    """Measures per product and day, the only aggregate that reads the whole fact.

    Grouped by product id alone: names would only widen the shuffle.
    """
    by_day = fact.groupBy("product_id", day_of("order_date").alias(DAY))
    return by_day.agg(*sales_measures())


def roll_up_days(by_day: DataFrame, period: str) -> DataFrame:
    """Weekly or monthly measures from daily ones, without another pass over the fact."""
    start = {WEEK: week_of, MONTH_START: month_of}[period](DAY)
    return by_day.groupBy("product_id", start.alias(period)).agg(*rolled_up_measures())


def as_mart(measures: DataFrame, products: DataFrame, period: str) -> DataFrame:
    """Add the product's names and the time of the refresh."""
    names = products.select(*PRODUCT_COLUMNS)
    values = [col for col in measures.columns if col not in ("product_id", period)]
    joined = measures.join(names, "product_id")
    return joined.select(
        *PRODUCT_COLUMNS, period, *values, F.current_timestamp().alias("_refreshed_at")
    )


def mart_daily(fact: DataFrame, products: DataFrame) -> DataFrame:
    return as_mart(sales_by_day(fact), products, DAY)


def mart_weekly(by_day: DataFrame, products: DataFrame) -> DataFrame:
    return as_mart(roll_up_days(by_day, WEEK), products, WEEK)


def mart_monthly(by_day: DataFrame, products: DataFrame) -> DataFrame:
    return as_mart(roll_up_days(by_day, MONTH_START), products, MONTH_START)


# ---- sales marts as they are stored ---------------------------------------------------------


def folder_of(period: str) -> str:
    """Days and weeks are too many to be folders: they are stored by the month they start in."""
    return MONTH_START if period == MONTH_START else MONTH


def names_fit(products: DataFrame) -> bool:
    """Whether the names are few enough to be broadcast, so that a mart can take them on wherever its rows are."""
    return broadcasts(products.select(*PRODUCT_COLUMNS))


def named(sums: DataFrame, products: DataFrame, period: str, fit: bool, *values: Column | str) -> DataFrame:
    """Rows of a mart with the product's names and the column that they are stored by."""
    names = products.select(*PRODUCT_COLUMNS)
    joined = sums.drop(MONTH).join(F.broadcast(names) if fit else names, "product_id")
    mart = joined.select(*PRODUCT_COLUMNS, period, *values)
    return mart if period == MONTH_START else mart.withColumn(MONTH, month_of(period))


def stored_mart_daily(fact: DataFrame, products: DataFrame, fit: bool) -> DataFrame:
    """The daily mart; where the names fit, its rows are shuffled to their months before the names widen them."""
    by_day = sales_by_day(fact)
    if fit:
        by_day = as_stored(by_day.withColumn(MONTH, month_of(DAY)), MONTH)
    return named(by_day, products, DAY, fit, *MEASURES, F.current_timestamp().alias("_refreshed_at"))


def stored_roll_up(
    by_day: DataFrame, products: DataFrame, period: str, fit: bool, large: dict[dt.date | None, int]
) -> DataFrame:
    """The weekly or monthly mart from the daily one, which has a row per product and day at most."""
    rows = by_day.withColumn(period, {WEEK: week_of, MONTH_START: month_of}[period](DAY))
    sums = sums_of_rows(rows, period, fit, large, *rolled_up_measures())
    return named(sums, products, period, fit, *MEASURES, F.current_timestamp().alias("_refreshed_at"))


def sums_of_rows(
    rows: DataFrame, period: str, fit: bool, large: dict[dt.date | None, int], *sums: Column
) -> DataFrame:
    """Sums per product and period of rows of which a product has few in a month.

    They are shuffled once before the names are joined: where these fit, to the folders in which they are stored, and
    by product where they do not, which is how the join needs them.
    """
    keys = ["product_id", period]
    if not fit:
        return rows.repartition("product_id").groupBy(*keys).agg(*sums)
    folder = folder_of(period)
    if folder != period:
        rows = rows.withColumn(folder, month_of(period))
    return add_up_by_folder(rows, keys, folder, list(sums), large)


# ---- order status -----------------------------------------------------------------------


def order_statuses(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Status of every order that has lines, as the view derives it."""
    query = order_status_view("{orders}", "{items}")
    return orders.sparkSession.sql(query, orders=orders, items=items)


def order_status_view(orders: str, items: str) -> str:
    """SQL of the status of every order that has lines: always derived, never stored.

    Lines are counted per order before the join: an order with very many lines shrinks to
    one row per task before anything is shuffled, and the join reuses the partitioning.
    """
    return f"""
        SELECT order_id, customer_id, order_date, total_line_items, delivered_count,
               shipped_count, pending_count, cancelled_count, returned_count,
               CASE WHEN delivered_count = total_line_items THEN 'COMPLETED'
                    WHEN cancelled_count = total_line_items THEN 'CANCELLED'
                    WHEN delivered_count + shipped_count > 0 THEN 'PARTIALLY_SHIPPED'
                    WHEN pending_count = total_line_items THEN 'PENDING'
                    ELSE 'IN_PROGRESS' END AS order_status
        FROM {orders} JOIN (
            SELECT order_id, count(*) AS total_line_items,
                   count_if(line_status = 'DELIVERED') AS delivered_count,
                   count_if(line_status = 'SHIPPED') AS shipped_count,
                   count_if(line_status = 'PENDING') AS pending_count,
                   count_if(line_status = 'CANCELLED') AS cancelled_count,
                   count_if(line_status = 'RETURNED') AS returned_count
            FROM {items} GROUP BY order_id
        ) USING (order_id)
    """


def dim_order(orders: DataFrame, statuses: DataFrame) -> DataFrame:
    """Order headers with the status stored for consumers that need a table.

    An order without lines has no status.
    """
    status = statuses.select("order_id", "total_line_items", "order_status")
    headers = orders.select("order_id", "customer_id", "order_date", "shipping_address")
    return headers.join(status, "order_id", "left")
