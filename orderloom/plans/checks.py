"""Data checks: what the layers promise, as queries that list the exceptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.measures import MEASURES, sales_measures
from orderloom.functions.periods import month_of
from orderloom.operators.integrity import REASON, duplicate_values, orphans, rejected
from orderloom.plans.gold import MONTH_START


def mart_vs_fact(monthly: DataFrame, fact: DataFrame) -> DataFrame:
    """Products and months for which the stored mart and the fact disagree on sales.

    Distinct orders are left out: the mart counts orders of every status.
    """
    keys = ["product_id", MONTH_START]
    measures = ["units_delivered", "revenue_delivered"]
    # Nothing is counted distinct, so lines add up to months at once, within a task and then over tasks.
    sums = [c for name, c in zip(MEASURES, sales_measures()) if name in measures]
    fresh = fact.groupBy("product_id", month_of("order_date").alias(MONTH_START)).agg(*sums)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *[F.col(k).alias(f"{name}_{k}") for k in keys],
            *[F.col(m).alias(f"{m}_{name}") for m in measures],
        )

    on = [F.col(f"mart_{k}").eqNullSafe(F.col(f"fact_{k}")) for k in keys]
    both = side(monthly, "mart").join(side(fresh, "fact"), on, "full")
    same = F.lit(True)
    for m in measures:
        same = same & F.col(f"{m}_mart").eqNullSafe(F.col(f"{m}_fact"))
    return both.where(~same).select(
        *[F.coalesce(f"mart_{k}", f"fact_{k}").alias(k) for k in keys],
        *[f"{m}_{s}" for m in measures for s in ("mart", "fact")],
    )


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Headers without a line; order ids of the lines are made distinct before the join."""
    ordered = items.select("order_id").distinct()
    return orphans(orders, ordered, "order_id").select("order_id", "customer_id", "order_date")


def quarantine_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """How many landed rows each table rejected, by reason."""
    parts = [
        rejected(checked).groupBy(REASON).agg(F.count("*").alias("n_rows"))
        .select(F.lit(name).alias("table_name"), REASON, "n_rows")
        for name, checked in tables.items()
    ]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    return counted


def duplicate_natural_keys(customers: DataFrame, products: DataFrame) -> DataFrame:
    """Emails and SKUs held by more than one row: reported, never merged."""

    def report(df: DataFrame, key: str) -> DataFrame:
        found = duplicate_values(df, key)
        return found.select(F.lit(key).alias("natural_key"), F.col(key).alias("value"), "n_rows")

    return report(customers, "email").unionByName(report(products, "sku"))
