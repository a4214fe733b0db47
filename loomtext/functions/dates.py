"""Date ranges and stamps of the batch jobs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_range(today: date, years_back: int = 0, months_back: int = 0) -> tuple[date, date]:
    """First of the month so many years and months ago, and the first of this month."""
    months = today.year * 12 + today.month - 1 - 12 * years_back - months_back
    return date(months // 12, months % 12 + 1, 1), today.replace(day=1)


def lookback_start(start: date, days: int = 120) -> date:
    """Open lower bound of what a rolling series from ``start`` reads."""
    return start - timedelta(days=days)


def last_four_quarters(today: date) -> list[str]:
    """The last four completed quarters, newest first, as q1yy."""
    n = today.year * 4 + (today.month - 1) // 3
    return [f"q{(n - k) % 4 + 1}{(n - k) // 4 % 100:02d}" for k in range(1, 5)]


def business_day_before(day: Column) -> Column:
    """The day before; on Mondays the Friday."""
    return F.date_sub(day, F.when(F.dayofweek(day) == 2, 3).otherwise(1))


def eastern(utc: Column) -> Column:
    return F.from_utc_timestamp(utc, "America/New_York")


def eastern_ntz(utc: Column) -> Column:
    """The same for timestamps without a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), utc)


def month_range_of(day: Column, years_back: int = 0, months_back: int = 0, legacy: bool = False) -> tuple[Column, Column]:
    """:func:`month_range` of a column; ``legacy``: the months are left out where years are given."""
    back = 12 * years_back + (0 if legacy and years_back else months_back)
    return F.trunc(F.add_months(day, -back), "MM"), F.trunc(day, "MM")


def quarters_before(day: Column, n: int) -> Column:
    """Names (q1yy) of the n completed quarters before a day's, newest first."""
    earlier = [F.add_months(F.trunc(day, "quarter"), -3 * k) for k in range(1, n + 1)]
    return F.array(*[F.concat(F.lit("q"), F.quarter(e).cast("string"), F.right(F.year(e).cast("string"), F.lit(2))) for e in earlier])


def stamp(at: Column, pattern: str) -> Column:
    return F.date_format(at, pattern)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
