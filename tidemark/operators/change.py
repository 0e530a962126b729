"""Change along each entity's history.

The windows here run over one entity's whole history in one task. That is bounded by the
calendar, not by the data: a panel has one row per date and entity, and the date has to be
a DATE, so a century of daily values is 36,525 rows. Raw rows, whatever their skew, are
brought to that grain first by ``to_panel``, which combines them before shuffling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import pct_change


def require_calendar(panel: DataFrame, date: str) -> None:
    """Refuse a date column that is no DATE: the calendar bounds what is built on it."""
    kind = panel.schema[date].dataType
    if not isinstance(kind, T.DateType):
        raise TypeError(f"{date!r} must be a DATE at panel grain, not {kind.simpleString()}")


def step_change(
    panel: DataFrame,
    *,
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
    change: str = "change_pct",
) -> DataFrame:
    """Add the percent change from the entity's previous observation.

    Missing values are left out first, so a gap is bridged. The first observation of an
    entity and one that follows a zero have no change (NULL).
    """
    require_calendar(panel, date)
    history = Window.partitionBy(entity).orderBy(date)
    present = panel.where(F.col(value).isNotNull())
    return present.withColumn(change, pct_change(F.col(value), F.lag(value).over(history)))


def mom_change(
    panel: DataFrame,
    *,
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
    change: str = "change_pct",
) -> DataFrame:
    """``step_change`` without the observations that have no change."""
    moves = step_change(panel, date=date, entity=entity, value=value, change=change)
    return moves.where(F.col(change).isNotNull())


def flag_outliers(
    moves: DataFrame,
    *,
    entity: str = "entity",
    change: str = "change_pct",
    sigmas: float = 3.0,
) -> DataFrame:
    """The moves further than ``sigmas`` sample deviations from their entity's mean move.

    Adds ``mean_change`` and ``sd_change``. A series that never varies has no outliers.
    The statistics are window aggregates on the partitioning the change already used, so
    neither a second shuffle nor a join back is needed.
    """
    whole = Window.partitionBy(entity)
    scored = moves.withColumns(
        {
            "mean_change": F.avg(change).over(whole),
            "sd_change": F.stddev_samp(change).over(whole),
        }
    )
    distance = F.abs(F.col(change) - F.col("mean_change"))
    return scored.where((F.col("sd_change") > 0) & (distance > sigmas * F.col("sd_change")))


def outliers(
    panel: DataFrame,
    *,
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
    change: str = "change_pct",
    sigmas: float = 3.0,
) -> DataFrame:
    """Outlying changes of a panel; change and statistics share one shuffle."""
    moves = step_change(panel, date=date, entity=entity, value=value, change=change)
    return flag_outliers(moves, entity=entity, change=change, sigmas=sigmas)


def rebase(
    panel: DataFrame,
    *,
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
    out: str = "index_100",
    base: float = 100.0,
) -> DataFrame:
    """Each series as a percentage of its own first present value (NULL if that is 0)."""
    require_calendar(panel, date)
    series = (
        Window.partitionBy(entity)
        .orderBy(date)
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    first = F.first(value, ignorenulls=True).over(series)
    present = panel.where(F.col(value).isNotNull())
    return present.withColumn(out, F.try_divide(F.col(value), first) * F.lit(base))


def growth(
    panel: DataFrame, *, date: str = "date", entity: str = "entity", value: str = "value"
) -> DataFrame:
    """First and last present value of each series and the percent change between them."""
    present = panel.where(F.col(value).isNotNull())
    ends = present.groupBy(entity).agg(
        F.min_by(value, date).alias("first_value"),
        F.max_by(value, date).alias("last_value"),
    )
    return ends.withColumn("growth_pct", pct_change(F.col("last_value"), F.col("first_value")))
