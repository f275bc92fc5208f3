"""Bronze to Silver: check, type, keep the newest version of every key.

`tagged_*` add to landed rows the reason why they must not enter Silver, or NULL. They carry
the landed text only: it is half as wide as text and typed values together, which counts in
the shuffles of the foreign-key joins. `typed` converts what passed. Rows are compared after
typing, so '1' and '01' are one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.config import LINE_STATUSES
from orderloom.functions import cleaning as c
from orderloom.functions.periods import month_of
from orderloom.operators.dedupe import collapse_exact, latest_by_key
from orderloom.operators.integrity import REASON, accepted, mark_referenced, rejected, tag_rejects
from orderloom.schemas import (
    BRONZE,
    CORRUPT,
    INGEST_TS,
    MONTH,
    SILVER_KEYS,
    SILVER_LAYOUT,
    UPDATED_TS,
    declared_columns,
)

# Reject reasons.
NULL_KEY = "null_key"
BAD_NUMBER = "bad_number"
BAD_STATUS = "bad_status"
BROKEN_ROW = "broken_row"
ORPHAN_CUSTOMER = "orphan_customer"
ORPHAN_ORDER = "orphan_order"
ORPHAN_PRODUCT = "orphan_product"
REASONS = (NULL_KEY, BAD_NUMBER, BAD_STATUS, BROKEN_ROW, ORPHAN_CUSTOMER, ORPHAN_ORDER, ORPHAN_PRODUCT)
# A parent may land later than its child: such rows are tried again.
RETRIED = (ORPHAN_CUSTOMER, ORPHAN_ORDER, ORPHAN_PRODUCT)

_READERS = {
    "customer_id": c.as_bigint,
    "product_id": c.as_bigint,
    "order_id": c.as_bigint,
    "order_item_id": c.as_bigint,
    "quantity": c.as_int,
    "unit_price": c.as_price,
    "email": c.clean_email,
    "sku": c.clean_code,
    "line_status": c.clean_code,
    "created_at": c.as_timestamp,
    "order_date": c.as_timestamp,
    "status_updated_at": c.as_timestamp,
}


# ---- checks on landed rows --------------------------------------------------------------


def _any(*conditions: Column) -> Column:
    found = conditions[0]
    for other in conditions[1:]:
        found = found | other
    return found


def _missing(*columns: str) -> Column:
    return _any(*[F.col(col).isNull() for col in columns])


def _unreadable(*columns: str) -> Column:
    """The value is there, but it is not of its type."""
    return _any(*[c.malformed(col, _READERS[col](col)) for col in columns])


def _refer(rows: DataFrame, parent: DataFrame, key: str, flag: str, *extra: str) -> DataFrame:
    """Mark rows whose key, read as a number, exists in the parent."""
    typed_key = f"_{key}"
    parents = parent.withColumnRenamed(key, typed_key)
    keyed = rows.withColumn(typed_key, c.as_bigint(key))
    return mark_referenced(keyed, parents, typed_key, flag, *extra).drop(typed_key)


def _tagged(rows: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Rows that did not fit their file's header are marked as such, whatever else is wrong."""
    if CORRUPT in rows.columns:
        rules = [(BROKEN_ROW, F.col(CORRUPT).isNotNull()), *rules]
    return tag_rejects(rows, rules)


def tagged_customers(bronze: DataFrame) -> DataFrame:
    return _tagged(
        bronze,
        [(NULL_KEY, _missing("customer_id", "email")), (BAD_NUMBER, _unreadable("customer_id"))],
    )


def tagged_products(bronze: DataFrame) -> DataFrame:
    return _tagged(
        bronze,
        [(NULL_KEY, _missing("product_id", "sku")), (BAD_NUMBER, _unreadable("product_id"))],
    )


def tagged_orders(bronze: DataFrame, customers: DataFrame) -> DataFrame:
    checked = _refer(bronze, customers, "customer_id", "has_customer")
    return _tagged(
        checked,
        [
            (NULL_KEY, _missing("order_id")),
            (BAD_NUMBER, _unreadable("order_id", "customer_id")),
            (ORPHAN_CUSTOMER, _missing("has_customer")),
        ],
    ).drop("has_customer")


def tagged_order_items(bronze: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Also adds the month of the order, under which the line is stored."""
    months = orders.select("order_id", month_of("order_date").alias(MONTH))
    checked = _refer(bronze, months, "order_id", "has_order", MONTH)
    checked = _refer(checked, products, "product_id", "has_product")
    numbers = ("order_item_id", "order_id", "product_id", "quantity", "unit_price")
    quantity, price = c.as_int("quantity"), c.as_price("unit_price")
    too_large = c.line_total(quantity, price).isNull() & quantity.isNotNull() & price.isNotNull()
    valid_status = F.coalesce(c.clean_code("line_status").isin(*LINE_STATUSES), F.lit(False))
    return _tagged(
        checked,
        [
            (NULL_KEY, _missing("order_item_id")),
            (BAD_NUMBER, _unreadable(*numbers) | too_large),
            (BAD_STATUS, ~valid_status),
            (ORPHAN_ORDER, _missing("has_order")),
            (ORPHAN_PRODUCT, _missing("has_product")),
        ],
    ).drop("has_order", "has_product")


# ---- Silver tables ----------------------------------------------------------------------


def typed(landed: DataFrame, table: str) -> DataFrame:
    """Landed rows in the declared shape of a Silver table, and the month it is stored by."""
    readers = {col: read(col) for col, read in _READERS.items() if col in landed.columns}
    rows = landed.withColumns(readers).withColumnRenamed(INGEST_TS, UPDATED_TS)
    if table == "silver_orders":
        rows = rows.withColumn(MONTH, month_of("order_date"))
    if table == "silver_order_items":
        rows = rows.withColumn("line_total", c.line_total(F.col("quantity"), F.col("unit_price")))
    layout = [col for col in [SILVER_LAYOUT[table]] if col]
    return rows.select(*declared_columns(table), *layout)


def newest_accepted(tagged: DataFrame, table: str) -> DataFrame:
    """Good rows as the table declares them, one per key."""
    return latest_by_key(typed(accepted(tagged), table), SILVER_KEYS[table], UPDATED_TS)


def quarantined(tagged: DataFrame, bronze_table: str) -> tuple[DataFrame, DataFrame]:
    """Rejected rows as they landed, with the reason: for good, and orphans; exact copies once."""
    kept = [c for c in [*BRONZE[bronze_table].names, CORRUPT] if c in tagged.columns]
    rows = collapse_exact(rejected(tagged).select(*kept, REASON), INGEST_TS)
    waiting = F.col(REASON).isin(*RETRIED)
    return rows.where(~waiting), rows.where(waiting)


def silver_customers(bronze: DataFrame) -> DataFrame:
    return newest_accepted(tagged_customers(bronze), "silver_customers")


def silver_products(bronze: DataFrame) -> DataFrame:
    return newest_accepted(tagged_products(bronze), "silver_products")


def silver_orders(bronze: DataFrame, customers: DataFrame) -> DataFrame:
    return newest_accepted(tagged_orders(bronze, customers), "silver_orders")


def silver_order_items(bronze: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    return newest_accepted(tagged_order_items(bronze, orders, products), "silver_order_items")
