"""Calendar periods: as columns for grouping, as dates for query bounds.

Bounds are worked out once on the driver and enter the plan as literals, so that filters on
them reach partition pruning and the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(ts: str) -> Column:
    return F.to_date(F.col(ts))


def week_of(ts: str) -> Column:
    """Monday of the week."""
    return F.trunc(day_of(ts), "week")


def month_of(ts: str) -> Column:
    """First day of the month."""
    return F.trunc(day_of(ts), "month")


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def week_start(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=day.weekday())


def next_month(day: dt.date) -> dt.date:
    return (month_start(day) + dt.timedelta(days=32)).replace(day=1)


def previous_month(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Half-open bounds of the calendar month before the one `as_of` lies in."""
    end = month_start(as_of)
    return month_start(end - dt.timedelta(days=1)), end


def previous_week(as_of: dt.date) -> dt.date:
    return week_start(as_of - dt.timedelta(days=7))


def weeks_of_months(months: list[dt.date]) -> list[dt.date]:
    """Every week that shares a day with one of the months."""
    weeks = set()
    for first in months:
        monday, end = week_start(first), next_month(first)
        while monday < end:
            weeks.add(monday)
            monday += dt.timedelta(days=7)
    return sorted(weeks)


def months_of(days: list[dt.date]) -> list[dt.date]:
    return sorted({month_start(d) for d in days})


def ordered(periods: Iterable[dt.date | None]) -> list[dt.date | None]:
    """Periods in their order without repeats; NULL, where rows have no date, comes last."""
    return sorted(set(periods), key=lambda p: (p is None, p))


def at(moment: dt.date) -> Column:
    """A timestamp literal; a plain date stands for its midnight."""
    if not isinstance(moment, dt.datetime):
        moment = dt.datetime.combine(moment, dt.time())
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")
