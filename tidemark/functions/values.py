"""Null-tolerant expressions that stay valid under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_date(column: Column, pattern: str | None = None) -> Column:
    """The date, or NULL where the text is no date."""
    return F.try_to_date(column, pattern) if pattern else F.try_to_date(column)


def lenient_number(column: Column) -> Column:
    """The double, or NULL where the text is no number. NaN counts as missing."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def unparseable(raw: Column, parsed: Column) -> Column:
    """True where a value was given but could not be read."""
    return raw.isNotNull() & parsed.isNull()


def pct_change(now: Column, before: Column) -> Column:
    """Change from ``before`` to ``now`` in percent; NULL when ``before`` is 0 or NULL."""
    return F.try_divide(now - before, before) * 100


def pct_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0."""
    return F.try_divide(part, whole) * 100


def within_domain(columns: list[str]) -> Column:
    """True where every column is missing or not negative."""
    rule = F.lit(True)
    for name in columns:
        rule = rule & (F.col(name).isNull() | (F.col(name) >= 0))
    return rule


def pearson(x: Column, y: Column) -> Column:
    """Aggregate: correlation over rows where both are present, NULL if one is constant.

    The built-in ``corr`` raises on a constant series under ANSI mode. The covariance leaves
    out rows that lack either value; the deviations are masked to the same rows.
    """
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    ratio = F.try_divide(F.covar_pop(x, y), spread)
    return F.when(F.abs(ratio) > 1, F.signum(ratio)).otherwise(ratio)
