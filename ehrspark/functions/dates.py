"""Date helpers: parsing, day counts, ages, month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAYS_PER_YEAR = 365.25


def parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Strict parse (bad text raises under ANSI, as in the reference)."""
    return F.to_date(text, fmt)


def year_start(year: Column) -> Column:
    """1 January of ``year`` (the reference parses the year with '%Y')."""
    return F.make_date(year, F.lit(1), F.lit(1))


def birth_date(year: Column, month: Column, day: Column) -> Column:
    return F.make_date(year, month, day)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days ``later - earlier``; may be negative."""
    return F.datediff(later, earlier)


def age_years(on_date: Column, year_of_birth: Column) -> Column:
    """Days since 1 January of the birth year divided by 365.25 (double)."""
    return F.datediff(on_date, year_start(year_of_birth)).cast("double") / F.lit(DAYS_PER_YEAR)


def months_before(d: Column, months: int) -> Column:
    """``d`` minus ``months`` calendar months, clamped to the month end."""
    return F.add_months(d, -months)
