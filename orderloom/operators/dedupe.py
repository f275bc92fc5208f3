"""Two ways to remove duplicates: exact copies, and older versions of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def collapse_exact(df: DataFrame, ts: str, alias: str | None = None) -> DataFrame:
    """One row per distinct combination of all columns but `ts`, with the newest `ts`.

    A plain hash aggregate: copies collapse before the shuffle, however many there are.
    """
    business = [c for c in df.columns if c != ts]
    return df.groupBy(*business).agg(F.max(ts).alias(alias or ts))


def latest_by_key(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The newest row of each key; rows with the same `ts` are decided by their other columns.

    Exact copies need no separate pass: the newest copy of a row is the one that can win.
    The rank filter lets Spark keep a single row per key and task before the shuffle, so
    a key with very many versions costs no more than any other.
    """
    ties = [c for c in df.columns if c not in keys and c != ts]
    newest_first = [F.col(c).desc_nulls_last() for c in [ts, *ties]]
    return first_by_key(df, keys, newest_first)


def first_by_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
