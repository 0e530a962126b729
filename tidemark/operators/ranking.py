"""Ordered views of a table: previews and extremes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def preview(df: DataFrame, order_by: Sequence, n: int = 10) -> DataFrame:
    """The first ``n`` rows of a total order; each task passes on ``n`` rows at most."""
    return df.orderBy(*order_by).limit(n)


def _ranked(moves: DataFrame, k: int, change: str, groups: Sequence[str], ties: Sequence[str]):
    """The first ``k`` rows of each group and direction, from one pass over ``moves``.

    Each row stands once for either direction, with its strength in that direction. A task
    passes on no more than ``k`` rows per group and direction (``WindowGroupLimit``).
    """
    sides = F.array(
        F.struct(F.lit("rise").alias("direction"), (-F.col(change)).alias("_strength")),
        F.struct(F.lit("fall").alias("direction"), F.col(change).alias("_strength")),
    )
    both = moves.where(F.col(change).isNotNull()).select("*", F.inline(sides))
    place = Window.partitionBy(*groups, "direction").orderBy("_strength", *ties)
    ranked = both.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.drop("_strength")


def extremes(
    moves: DataFrame,
    *,
    k: int = 5,
    change: str = "change_pct",
    ties: Sequence[str] = ("date", "entity"),
) -> DataFrame:
    """The ``k`` largest rises and the ``k`` largest falls, ranked within each direction."""
    return _ranked(moves, k, change, [], ties)


def extremes_per_entity(
    moves: DataFrame,
    *,
    k: int = 5,
    entity: str = "entity",
    change: str = "change_pct",
    ties: Sequence[str] = ("date",),
) -> DataFrame:
    """The ``k`` largest rises and the ``k`` largest falls of each entity."""
    return _ranked(moves, k, change, [entity], ties)


def largest_first(df: DataFrame, column: str, *ties: str) -> DataFrame:
    """Rows by descending absolute value of ``column``."""
    return df.orderBy(F.desc(F.abs(F.col(column))), *ties)
