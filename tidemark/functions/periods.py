"""Calendar periods as whole numbers, so that series can be aligned by period."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of each grain in months, or in days.
MONTHS = {"month": 1, "quarter": 3, "year": 12}
DAYS = {"day": 1, "week": 7}

# Days from the epoch, a Thursday, back to the Monday of its week.
EPOCH_WEEKDAY = 3


def _checked(grain: str) -> str:
    if grain not in MONTHS and grain not in DAYS:
        raise ValueError(f"unknown grain {grain!r}")
    return grain


def period_number(date: Column, grain: str = "month") -> Column:
    """The number of the period a date lies in; neighbouring periods differ by one."""
    if _checked(grain) in MONTHS:
        months = F.year(date) * 12 + F.month(date) - 1
        return F.floor(months / F.lit(MONTHS[grain])).cast("int")
    shift = EPOCH_WEEKDAY if grain == "week" else 0
    return F.floor((F.unix_date(date) + shift) / F.lit(DAYS[grain])).cast("int")


def periods_on(date: Column, steps: Column, grain: str = "month") -> Column:
    """The date some whole periods after ``date``."""
    if _checked(grain) in MONTHS:
        return F.add_months(date, (steps * MONTHS[grain]).cast("int"))
    return F.date_add(date, (steps * DAYS[grain]).cast("int"))
