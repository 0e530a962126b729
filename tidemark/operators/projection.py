"""Short projections of each series, and how they would have done in the past.

Three forms: the straight line through a series, the last season repeated, and a backtest of
both that moves the origin of the projection along the history. A line is a matter of moments
that merge, so its one shuffle carries one row per task and entity; the others read an entity's
history in order, which the calendar bounds (see ``change``). Seasons and steps are aligned by
period, not by row: a gap in a series shifts nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.periods import period_number, periods_on
from tidemark.operators.change import require_calendar


def _numbered(panel: DataFrame, date: str, value: str, grain: str) -> DataFrame:
    """Present values with the number of their period."""
    require_calendar(panel, date)
    return panel.where(F.col(value).isNotNull()).withColumn("_at", period_number(F.col(date), grain))


def trend(
    panel: DataFrame,
    *,
    horizon: int = 6,
    sigmas: float = 1.96,
    grain: str = "month",
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
) -> DataFrame:
    """The least-squares line of each series, carried ``horizon`` periods past its last one.

    ``(entity, step, date, n, slope, residual_sd, projected, low, high)``: slope per period, deviation
    of the residuals, and the band of ``sigmas`` deviations of a new observation. A series of one
    period has no line, one of two no deviation; the columns are NULL then. Merged are counts,
    means and centred sums, never sums of squares.
    """
    at, y = F.col("_at"), F.col(value)
    fitted = (
        _numbered(panel, date, value, grain)
        .groupBy(entity)
        .agg(
            F.count(y).alias("n"),
            F.max(date).alias("_last_date"),
            F.max(at).alias("_last"),
            F.avg(at).alias("_mean_at"),
            F.avg(y).alias("_mean"),
            F.regr_sxx(y, at).alias("_sxx"),
            F.regr_syy(y, at).alias("_syy"),
            F.regr_sxy(y, at).alias("_sxy"),
        )
        .withColumn("slope", F.try_divide("_sxy", "_sxx"))
    )
    left = F.greatest(F.col("_syy") - F.col("slope") * F.col("_sxy"), F.lit(0.0))
    freedom = F.when(F.col("n") > 2, F.col("n") - 2)
    steps = fitted.withColumn("residual_sd", F.sqrt(left / freedom)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    )
    away = F.col("_last") + F.col("step") - F.col("_mean_at")
    projected = F.col("_mean") + F.col("slope") * away
    leverage = 1 + F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide(away * away, F.col("_sxx"))
    margin = sigmas * F.col("residual_sd") * F.sqrt(leverage)
    return steps.select(
        entity,
        "step",
        periods_on(F.col("_last_date"), F.col("step"), grain).alias(date),
        "n",
        "slope",
        "residual_sd",
        projected.alias("projected"),
        (projected - margin).alias("low"),
        (projected + margin).alias("high"),
    )


def _at_distance(history, value: str, periods: int) -> Column:
    """The value some periods after (before, if negative) each row's period, if there is one."""
    return F.max(value).over(history.rangeBetween(periods, periods))


def _history(entity: str):
    return Window.partitionBy(entity).orderBy("_at")


def seasonal_change(
    panel: DataFrame,
    *,
    season: int = 12,
    grain: str = "month",
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
) -> DataFrame:
    """Add ``season_value``, the value one season before, and the percent change from it."""
    rows = _numbered(panel, date, value, grain)
    before = _at_distance(_history(entity), value, -season)
    compared = rows.withColumn("season_value", before).drop("_at")
    step = F.col(value) - F.col("season_value")
    return compared.withColumn("season_change_pct", F.try_divide(step, F.col("season_value")) * 100)


def seasonal(
    panel: DataFrame,
    *,
    horizon: int = 12,
    season: int = 12,
    grain: str = "month",
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
) -> DataFrame:
    """The last season of each series repeated, ``horizon`` periods past its last one.

    ``(entity, step, date, based_on, projected, projected_drift)``: ``based_on`` is the date repeated, and
    the drift is the series' mean change over a season, once for each season gone (0 if no two of its
    values are a season apart). A period without a value in the last season projects nothing.
    """
    whole = Window.partitionBy(entity)
    rows = _numbered(panel, date, value, grain)
    change = F.col(value) - _at_distance(_history(entity), value, -season)
    rows = rows.withColumn("_change", change).withColumns(
        {"_drift": F.coalesce(F.avg("_change").over(whole), F.lit(0.0)), "_last": F.max("_at").over(whole)}
    )
    recent = rows.where(F.col("_at") > F.col("_last") - season)
    repeated = recent.withColumn("_seasons", F.explode(F.sequence(F.lit(1), F.lit(-(-horizon // season)))))
    ahead = F.col("_seasons") * season
    repeated = repeated.withColumn("step", F.col("_at") + ahead - F.col("_last")).where(F.col("step") <= horizon)
    return repeated.select(
        entity,
        "step",
        periods_on(F.col(date), ahead, grain).alias("_date"),
        F.col(date).alias("based_on"),
        F.col(value).alias("projected"),
        (F.col(value) + F.col("_seasons") * F.col("_drift")).alias("projected_drift"),
    ).withColumnRenamed("_date", date)


def rolling_origins(
    panel: DataFrame,
    *,
    horizon: int = 3,
    season: int = 12,
    least: int = 24,
    grain: str = "month",
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
) -> DataFrame:
    """``(entity, origin, method, step, projected, actual)`` of every origin with ``least`` values so far.

    At each period of a series, both methods project the next ``horizon`` from what was known then:
    ``trend`` by the line through all values up to there, ``seasonal`` by the value of the same period
    in the last season. Pairs without a projection or an actual value are left out. One window
    over the history serves all origins and steps.
    """
    history = _history(entity)
    known = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at, y = F.col("_at"), F.col(value)
    columns = {
        "_n": F.count(y).over(known),
        "_mean": F.avg(y).over(known),
        "_mean_at": F.avg(at).over(known),
        "_slope": F.regr_slope(y, at).over(known),
    }
    for step in range(1, horizon + 1):
        columns[f"_actual_{step}"] = _at_distance(history, value, step)
        columns[f"_season_{step}"] = _at_distance(history, value, step - season * (-(-step // season)))
    rows = _numbered(panel, date, value, grain).withColumns(columns).where(F.col("_n") >= least)
    pairs = []
    for step in range(1, horizon + 1):
        line = F.col("_mean") + F.col("_slope") * (at + step - F.col("_mean_at"))
        for method, projected in (("trend", line), ("seasonal", F.col(f"_season_{step}"))):
            pairs.append(
                F.struct(
                    F.lit(method).alias("method"),
                    F.lit(step).alias("step"),
                    projected.alias("projected"),
                    F.col(f"_actual_{step}").alias("actual"),
                )
            )
    tried = rows.select(entity, F.col(date).alias("origin"), F.inline(F.array(*pairs)))
    return tried.where("projected IS NOT NULL AND actual IS NOT NULL")


def backtest(panel: DataFrame, *, entity: str = "entity", **options) -> DataFrame:
    """``(entity, method, step, n, mae, rmse, mape, bias)`` over all rolling origins of a series.

    Mean absolute and root mean squared error, mean absolute error in percent of the actual value (those
    of 0 left out) and mean error. Options are those of ``rolling_origins``.
    """
    tried = rolling_origins(panel, entity=entity, **options)
    error = F.col("projected") - F.col("actual")
    return tried.groupBy(entity, "method", "step").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.try_divide(F.abs(error), F.abs("actual"))) * 100).alias("mape"),
        F.avg(error).alias("bias"),
    )
