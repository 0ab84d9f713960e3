"""Dates, month grids and guarded numbers as Column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column) -> Column:
    """The first d/m/yyyy in a text, day first; null if there is none or it is no date."""
    return F.to_date(F.try_to_timestamp(F.regexp_extract(c, r"\d{1,2}/\d{1,2}/\d{4}", 0), F.lit("d/M/yyyy")))


def iso_date(c: Column) -> Column:
    """The first ten characters as an ISO date; null if they are none."""
    return F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")))


def month_grid(first: Column, last: Column) -> Column:
    """The month ends from the month of ``first`` to that of ``last``; [] if first is later."""
    months = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
    return F.when(F.trunc(first, "MM") <= F.trunc(last, "MM"), F.transform(months, lambda m: F.last_day(m))).otherwise(F.array().cast("array<date>"))


def month_ends(first: date, last: date) -> list[date]:
    """The same on the driver, for a grid of fixed bounds."""
    out, y, m = [], first.year, first.month
    while (y, m) <= (last.year, last.month):
        nxt = date(y + m // 12, m % 12 + 1, 1)
        out.append(date.fromordinal(nxt.toordinal() - 1))
        y, m = nxt.year, nxt.month
    return out


def months_between(a: Column, b: Column) -> Column:
    """Calendar months from a to b; the day does not count."""
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def year_start(as_of: Column, years: int) -> Column:
    """The first of the same month ``years`` earlier."""
    return F.trunc(F.add_months(as_of, -12 * years), "MM")


def rounded_sum(c: Column) -> Column:
    return F.round(F.sum(c), 2)


def null_if_zero(c: Column) -> Column:
    return F.nullif(F.coalesce(c, F.lit(0.0)), F.lit(0.0))


def guarded_ratio(a: Column, b: Column, least: float) -> Column:
    """a / b to four places where b is at least ``least``."""
    return F.when(b >= least, F.round(a / b, 4))
