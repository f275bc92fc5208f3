"""Text normalisation and tolerant string-to-type conversion.

Landed strings may be malformed. A failed conversion yields NULL instead of failing the job
(plain casts raise under ANSI mode), and `malformed` tells a bad value from a missing one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.schemas import LINE_MONEY, MONEY


def clean_email(c: str) -> Column:
    return F.lower(F.trim(F.col(c)))


def clean_code(c: str) -> Column:
    """Codes compared without regard to case or outer blanks: SKUs and line statuses."""
    return F.upper(F.trim(F.col(c)))


def full_name(first: str, last: str) -> Column:
    """Both names with one blank between; a missing one is skipped."""
    return F.concat_ws(" ", F.col(first), F.col(last))


def as_bigint(c: str) -> Column:
    return F.col(c).try_cast("bigint")


def as_int(c: str) -> Column:
    return F.col(c).try_cast("int")


def as_price(c: str) -> Column:
    return F.col(c).try_cast(MONEY)


def as_timestamp(c: str) -> Column:
    return F.col(c).try_cast("timestamp")


def line_total(quantity: Column, unit_price: Column) -> Column:
    """Quantity times the price snapshot of the line; NULL where it does not fit."""
    return (quantity * unit_price).try_cast(LINE_MONEY)


def malformed(raw: str, typed: Column) -> Column:
    """The source sent a value, but it cannot be read as its type."""
    return F.col(raw).isNotNull() & typed.isNull()
