"""Statistics per entity and per year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAT_NAMES = ("mean_value", "min_value", "max_value", "sd_value")


def annual_stats(
    panel: DataFrame,
    *,
    year: str = "year",
    entity: str = "entity",
    value: str = "value",
    names: Sequence[str] = STAT_NAMES,
) -> DataFrame:
    """Mean, minimum, maximum and sample deviation per year and entity."""
    mean, low, high, deviation = names
    return panel.groupBy(year, entity).agg(
        F.avg(value).alias(mean),
        F.min(value).alias(low),
        F.max(value).alias(high),
        F.stddev_samp(value).alias(deviation),
    )


def volatility(
    moves: DataFrame, by: Sequence[str], *, change: str = "change_pct", out: str = "volatility"
) -> DataFrame:
    """Sample deviation of the changes per group: per entity, or per entity and year."""
    return moves.groupBy(*by).agg(F.stddev_samp(change).alias(out))


def peak_period(
    by_period: DataFrame,
    *,
    period: str = "year",
    entity: str = "entity",
    measure: str = "volatility",
) -> DataFrame:
    """Per entity the period with the highest measure, the earliest one among equals.

    Periods without a measure do not compete; an entity whose measure is 0 throughout has
    no peak and keeps its row with a NULL period.
    """
    contest = F.when(F.col(measure).isNotNull(), F.struct(F.col(measure), -F.col(period)))
    best = by_period.groupBy(entity).agg(
        F.max_by(period, contest).alias("_period"), F.max(measure).alias(f"peak_{measure}")
    )
    return best.select(
        entity,
        F.when(F.col(f"peak_{measure}") > 0, F.col("_period")).alias(f"peak_{period}"),
        f"peak_{measure}",
    )
