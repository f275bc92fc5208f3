import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions import cleaning as c
from orderloom.functions import periods as p


def one(spark, value, expression):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expression("v")).first()[0]


@pytest.mark.parametrize(
    "expression, value, expected",
    [
        (c.clean_email, "  A@B.Test ", "a@b.test"),
        (c.clean_code, " sku-1 ", "SKU-1"),
        (c.clean_code, "\tsku", "\tSKU"),  # blanks only, tabs stay
        (c.as_bigint, "007", 7),
        (c.as_bigint, "7.9", None),
        (c.as_bigint, "", None),
        (c.as_int, "3000000000", None),
        (c.as_price, "129.995", Decimal("130.00")),
        (c.as_price, "123456789.00", None),
        (c.as_timestamp, "2024-02-29 01:02:03", dt.datetime(2024, 2, 29, 1, 2, 3)),
        (c.as_timestamp, "2023-02-29 00:00:00", None),
    ],
)
def test_cleaning_and_typing(spark, expression, value, expected):
    assert one(spark, value, expression) == expected


def test_malformed_is_not_missing(spark):
    df = spark.createDataFrame([("x",), ("1",), (None,)], "v string")
    bad = df.where(c.malformed("v", c.as_int("v")))
    assert [r.v for r in bad.collect()] == ["x"]


def test_line_total_type_and_overflow(spark):
    df = spark.sql("SELECT 3 AS q, CAST(1.25 AS DECIMAL(10,2)) AS p UNION ALL SELECT 2000000000, 99999999.99")
    out = df.select(c.line_total(F.col("q"), F.col("p")).alias("t"))
    assert dict(out.dtypes)["t"] == "decimal(12,2)"
    assert [r.t for r in out.collect()] == [Decimal("3.75"), None]


@pytest.mark.parametrize(
    "ts, day, week, month",
    [
        ("2026-03-08 23:59:59", "2026-03-08", "2026-03-02", "2026-03-01"),  # a Sunday
        ("2026-03-09 00:00:00", "2026-03-09", "2026-03-09", "2026-03-01"),
        ("2024-12-31 12:00:00", "2024-12-31", "2024-12-30", "2024-12-01"),
    ],
)
def test_periods_of_a_timestamp(spark, ts, day, week, month):
    df = spark.createDataFrame([(ts,)], "v string").select(F.col("v").cast("timestamp").alias("v"))
    found = df.select(p.day_of("v"), p.week_of("v"), p.month_of("v")).first()
    assert [str(x) for x in found] == [day, week, month]


def test_bounds():
    d = dt.date
    assert p.previous_month(d(2026, 4, 20)) == (d(2026, 3, 1), d(2026, 4, 1))
    assert p.previous_month(d(2026, 1, 31)) == (d(2025, 12, 1), d(2026, 1, 1))
    assert p.previous_month(d(2024, 3, 31)) == (d(2024, 2, 1), d(2024, 3, 1))
    assert p.previous_week(d(2026, 4, 20)) == d(2026, 4, 13)
    assert p.previous_week(d(2026, 4, 19)) == d(2026, 4, 6)
    assert p.next_month(d(2024, 12, 5)) == d(2025, 1, 1)
    assert p.weeks_of_months([d(2024, 2, 1)]) == [d(2024, 1, 29), d(2024, 2, 5), d(2024, 2, 12), d(2024, 2, 19), d(2024, 2, 26)]
    assert p.months_of([d(2024, 2, 9), d(2024, 2, 1), d(2024, 1, 29)]) == [d(2024, 1, 1), d(2024, 2, 1)]
