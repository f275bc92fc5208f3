"""Sales measures and order-status rules, shared by every grain and every query."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.config import CANCELLED, DELIVERED, LINE_STATUSES, PENDING, RETURNED, SHIPPED

REVENUE_TYPE = "decimal(22,2)"
UNIT_COLUMNS = {
    DELIVERED: "units_delivered",
    SHIPPED: "units_shipped",
    PENDING: "units_pending",
    CANCELLED: "units_cancelled",
    RETURNED: "units_returned",
}
#: Columns of the measures, in the order of the marts.
MEASURES = [
    UNIT_COLUMNS[DELIVERED],
    "revenue_delivered",
    *[c for s, c in UNIT_COLUMNS.items() if s != DELIVERED],
    "distinct_orders",
]
COUNT_COLUMNS = {
    DELIVERED: "delivered_count",
    SHIPPED: "shipped_count",
    PENDING: "pending_count",
    CANCELLED: "cancelled_count",
    RETURNED: "returned_count",
}


def _has(status: str) -> Column:
    return F.col("line_status") == status


def units_with(status: str) -> Column:
    return F.sum(F.when(_has(status), F.col("quantity")).otherwise(0))


def delivered_revenue() -> Column:
    return F.sum(F.when(_has(DELIVERED), F.col("line_total")).otherwise(0)).cast(REVENUE_TYPE)


def sales_measures() -> list[Column]:
    """Measures of a group of fact lines. Orders of every status count as distinct orders."""
    return [
        units_with(DELIVERED).alias(UNIT_COLUMNS[DELIVERED]),
        delivered_revenue().alias("revenue_delivered"),
        *[units_with(s).alias(c) for s, c in UNIT_COLUMNS.items() if s != DELIVERED],
        F.countDistinct("order_id").alias("distinct_orders"),
    ]


def rolled_up_measures() -> list[Column]:
    """The same measures for a longer period, from rows that hold them for its days.

    Units and revenue add up. So do the distinct orders: an order has one order date, hence
    the orders of two different days are different orders.
    """
    return [
        F.sum(UNIT_COLUMNS[DELIVERED]).alias(UNIT_COLUMNS[DELIVERED]),
        F.sum("revenue_delivered").cast(REVENUE_TYPE).alias("revenue_delivered"),
        *[F.sum(c).alias(c) for s, c in UNIT_COLUMNS.items() if s != DELIVERED],
        F.sum("distinct_orders").alias("distinct_orders"),
    ]


assert set(UNIT_COLUMNS) == set(COUNT_COLUMNS) == set(LINE_STATUSES)
