"""Selecting, naming and typing columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import quoted, resolve
from tidemark.functions.values import lenient_date, lenient_number


def conform(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select the mapping's source columns under its target names, in its order.

    A source may be given by its raw or its technical name.
    """
    found = resolve(df.columns, mapping)
    return df.select(*[F.col(quoted(found[src])).alias(dst) for src, dst in mapping.items()])


def typed(
    df: DataFrame,
    *,
    dates: Iterable[str] = (),
    numbers: Iterable[str] = (),
    pattern: str | None = None,
) -> DataFrame:
    """Read dates and numbers from their columns in place; unreadable values become NULL."""
    changes = {name: lenient_date(F.col(name), pattern) for name in dates}
    changes.update({name: lenient_number(F.col(name)) for name in numbers})
    return df.withColumns(changes)


def calendar_parts(
    df: DataFrame, date: str = "date", *, year: str = "year", month: str = "month"
) -> DataFrame:
    """Add the year and month of a date."""
    return df.withColumns({year: F.year(date), month: F.month(date)})


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    return reduce(DataFrame.unionByName, frames)
