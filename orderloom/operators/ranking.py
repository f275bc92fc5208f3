"""Ranking of products by what they sold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_sellers(df: DataFrame, first: str, second: str, k: int | None = None) -> DataFrame:
    """Highest `first`, ties by `second`, then by SKU; the best `k` rows or all of them.

    With `k`, every task keeps k rows only; the whole ranking is a range-partitioned sort.
    """
    ranked = df.orderBy(F.col(first).desc(), F.col(second).desc(), F.col("sku"))
    return ranked if k is None else ranked.limit(k)
