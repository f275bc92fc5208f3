"""Row checks: reject reasons, foreign keys, duplicate natural keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def tag_rejects(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Add the name of the first rule a row breaks; NULL means the row is good."""
    reasons = [F.when(broken, F.lit(name)) for name, broken in rules]
    return df.withColumn(REASON, F.coalesce(*reasons))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def mark_referenced(df: DataFrame, parent: DataFrame, key: str, flag: str, *extra: str) -> DataFrame:
    """Add `flag`: true where `key` exists in `parent`, whose `key` must be unique.

    Columns `extra` of the parent come along. One join answers both which rows are good and
    which are orphans. Adaptive execution splits a hot key on the left side.
    """
    return df.join(parent.select(key, F.lit(True).alias(flag), *extra), key, "left")


def keep_referenced(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose `key` exists in `parent`; a semi join cannot multiply rows."""
    return df.join(parent.select(key), key, "left_semi")


def orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return df.join(parent.select(key), key, "left_anti")


def duplicate_values(df: DataFrame, key: str) -> DataFrame:
    """Values of `key` that more than one row holds."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    return counted.where(F.col("n_rows") > 1)
