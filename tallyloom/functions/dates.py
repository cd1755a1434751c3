"""Date expressions: keys, ages, months and bi-weekly periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Start of period 1 of 2023; the pay date is 20 days after a period starts.
PERIOD_ANCHOR = "2022-12-17"
PERIOD_DAYS = 14
PAY_DATE_LAG = 20


def moment(value: dt.datetime | dt.date | str | Column) -> Column:
    """A point in time without zone, comparable with stored timestamps as they are."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def back(value, years: int = 0, months: int = 0) -> Column:
    """Calendar subtraction; 29 February clamps to 28."""
    return moment(value) - F.make_ym_interval(F.lit(years), F.lit(months))


def day_key(value: Column) -> Column:
    """Strict ``yyyyMMdd`` text or integer to date; other text raises under ANSI."""
    return F.to_date(value.cast("string"), "yyyyMMdd")


def day_key_or_null(value: Column) -> Column:
    """``yyyyMMdd`` where negative numbers stand for no date."""
    return day_key(F.when(value.cast("bigint") >= 0, value))


def clock(ts: Column) -> Column:
    """Time of day as ``HHmm``."""
    return F.date_format(ts, "HHmm")


def lenient_date(*candidates: Column) -> Column:
    """First candidate that reads as month/day/year; junk gives null.

    The shape is tested first, as a failed parse costs an exception per row.
    """
    shape = r"^\d{1,2}/\d{1,2}/\d{4}$"
    return F.coalesce(
        *[F.when(c.rlike(shape), F.try_to_date(c, "M/d/yyyy")) for c in candidates]
    )


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def _before(part: str, left: Column, right: Column) -> Column:
    extract = {"month": F.month, "day": F.day}[part]
    return extract(left) < extract(right)


def age_years(born: Column, on: Column) -> Column:
    """Completed years; a 29 February birthday has not come on 28 February."""
    not_yet = _before("month", on, born) | (
        (F.month(on) == F.month(born)) & _before("day", on, born)
    )
    return F.year(on) - F.year(born) - not_yet.cast("int")


def age_months(born: Column, on: Column, up_to_years: int = 2) -> Column:
    """Completed months, only while the age in years is at most ``up_to_years``."""
    months = (
        (F.year(on) - F.year(born)) * 12
        + F.month(on)
        - F.month(born)
        - _before("day", on, born).cast("int")
    )
    return F.when(age_years(born, on) <= up_to_years, months)


def first_period(year: Column, anchor: str = PERIOD_ANCHOR) -> Column:
    """Start of period 1: the first whose pay date falls in ``year``.

    Closed form of walking in two-week steps from the anchor.
    """
    base = F.lit(anchor).cast("date")
    gap = F.datediff(F.make_date(year, F.lit(1), F.lit(1)), F.date_add(base, PAY_DATE_LAG))
    steps = F.ceil(gap / F.lit(PERIOD_DAYS)).cast("int")
    return F.date_add(base, steps * PERIOD_DAYS)


def period_start(period: Column, anchor: str = PERIOD_ANCHOR) -> Column:
    """Start date of ``YYYY-NN``; null when the year has no such period."""
    shaped = F.when(period.rlike(r"^\d{4}-\d{2}$"), period)
    year = F.substring(shaped, 1, 4).try_cast("int")
    number = F.substring(shaped, 6, 2).try_cast("int")
    start = F.date_add(first_period(year, anchor), (number - 1) * PERIOD_DAYS)
    ends_in = F.year(F.date_add(start, PERIOD_DAYS - 1))
    return F.when((number >= 1) & (ends_in <= year), start)


def days_in_month(day: Column) -> Column:
    return F.day(F.last_day(day))


def month_parts(start: Column) -> Column:
    """A period's parts as ``array<struct<day date, days int, share double>>``, one per month.

    ``day`` lies in the month, ``days`` of the period fall into it, ``share`` is that over 14.
    """
    end = F.date_add(start, PERIOD_DAYS - 1)
    here = F.least(F.lit(PERIOD_DAYS), days_in_month(start) - F.day(start) + 1)

    def part(day, days):
        return F.struct(day.alias("day"), days.alias("days"), (days / F.lit(PERIOD_DAYS)).alias("share"))

    return F.when(F.month(start) == F.month(end), F.array(part(start, here))).otherwise(
        F.array(part(start, here), part(end, F.lit(PERIOD_DAYS) - here))
    )
