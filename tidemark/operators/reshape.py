"""Between wide tables and panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import quoted


def _keyed_rows(df: DataFrame, date: Column, entity: Column, value: Column, grain: str):
    if grain not in ("day", "week", "month", "quarter", "year"):
        raise ValueError(f"unknown grain {grain!r}")
    day = date.cast("date")
    return df.select(
        (day if grain == "day" else F.trunc(day, grain)).alias("date"),
        entity.alias("entity"),
        F.nanvl(value.cast("double"), F.lit(None).cast("double")).alias("value"),
    ).where("date IS NOT NULL AND entity IS NOT NULL")


def _from_units(how: str, decimals: int) -> Column:
    """The sum or mean of values held as whole units and their number."""
    if how not in ("avg", "sum"):
        raise ValueError(f"how must be 'avg' or 'sum', not {how!r}")
    total = F.col("units").cast("double") / 10**decimals
    return F.try_divide(total, F.col("n")) if how == "avg" else total


# Rows of which a task may hold a cell each while it adds them up: below 1 GB with all that it keeps.
TASK_ROWS = 1 << 20

# Parts into which the rows of one cell are dealt before they are added up.
SALTS = 16


def cell_tasks(df: DataFrame, task_rows: int = TASK_ROWS) -> int | None:
    """The tasks over which cells of ``df`` have to be dealt so that each has some ``task_rows``.

    None where the session's shuffle partitions are as many. It counts the rows of ``df``: of a
    Parquet table from the files' footers.
    """
    tasks = -(-df.count() // task_rows)
    return tasks if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def cell_sums(rows: DataFrame, sums: Sequence[str], tasks: int | None = None) -> DataFrame:
    """``(date, entity)`` and the sums of whole-number columns; NULL where all are NULL.

    Rows are combined before the shuffle. With nearly as many cells as rows that saves nothing, and
    a task of the shuffle holds its part of all cells: ``tasks`` deals them over so many, by entity,
    so that what follows by cell or by entity needs no other shuffle. A cell with very many rows is
    added up in ``SALTS`` parts first.
    """
    totals = [F.sum(name).alias(name) for name in sums]
    if tasks is None:
        return rows.groupBy("date", "entity").agg(*totals)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    dealt = rows.withColumn("_salt", salt).repartition(tasks, "date", "entity", "_salt")
    parts = dealt.groupBy("date", "entity", "_salt").agg(*totals).drop("_salt")
    return parts.repartition(tasks, "entity").groupBy("date", "entity").agg(*totals)


def panel_sums(
    df: DataFrame,
    *,
    date: Column,
    entity: Column,
    value: Column,
    decimals: int,
    grain: str = "month",
    tasks: int | None = None,
) -> DataFrame:
    """``(date, entity, units, n)``: exact sums in units of the last decimal, and counts.

    ``tasks`` is for panels with nearly as many cells as rows, see ``cell_sums``.
    """
    keyed = _keyed_rows(df, date, entity, value, grain)
    units = F.rint(F.col("value") * 10**decimals).cast("long")
    if tasks is None:
        return keyed.groupBy("date", "entity").agg(F.sum(units).alias("units"), F.count("value").alias("n"))
    present = F.col("value").isNotNull().cast("long")
    return cell_sums(keyed.select("date", "entity", units.alias("units"), present.alias("n")), ["units", "n"], tasks)


def roll_up(
    sums: DataFrame, by: Sequence[str], *, decimals: int, how: str = "avg", out: str = "value"
) -> DataFrame:
    """Sums brought to coarser keys, as the sum or the mean over all rows behind them."""
    coarse = sums.groupBy(*by).agg(F.sum("units").alias("units"), F.sum("n").alias("n"))
    return coarse.select(*by, _from_units(how, decimals).alias(out))


def to_panel(
    df: DataFrame,
    *,
    date: Column,
    entity: Column,
    value: Column,
    how: str = "avg",
    grain: str = "month",
    decimals: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Collapse raw rows to one row per (period, entity): ``(date, entity, value)``.

    Values are combined before the shuffle, so however many raw rows an entity has, what
    leaves a task is at most one row per period and entity. NaN is a missing value. Rows
    without date or entity have no place in a panel; leaving them out here, rather than
    wherever a later join implies it, keeps the shuffle identical in all branches of a
    report, so that Spark runs it once. With ``decimals`` the values are summed as whole
    units of that many decimals: the sum is then exact and does not depend on the order in
    which partial results arrive. ``tasks`` goes with ``decimals``, see ``cell_sums``.
    """
    keys = {"date": date, "entity": entity, "value": value, "grain": grain}
    if decimals is not None:
        combined = _from_units(how, decimals).alias("value")
        return panel_sums(df, **keys, decimals=decimals, tasks=tasks).select("date", "entity", combined)
    if how not in ("avg", "sum"):
        raise ValueError(f"how must be 'avg' or 'sum', not {how!r}")
    combined = F.avg("value") if how == "avg" else F.sum("value")
    return _keyed_rows(df, **keys).groupBy("date", "entity").agg(combined.alias("value"))


def unpivot_long(
    wide: DataFrame,
    *,
    ids: Sequence[str],
    measures: Mapping[str, int | str],
    entity: str = "entity",
    value: str = "value",
) -> DataFrame:
    """One row per id columns and present measure; ``measures`` maps column -> entity key.

    The measures are read in one scan and expanded in place; no branch per measure and no
    join for the key.
    """
    labels = {str(key): key for key in measures.values()}
    if len(labels) != len(measures):
        raise ValueError(f"entity keys must be unique: {measures}")
    relabelled = wide.select(
        *ids, *[F.col(quoted(name)).alias(str(key)) for name, key in measures.items()]
    )
    long = relabelled.unpivot(list(ids), [quoted(name) for name in labels], entity, value)
    if all(isinstance(key, int) for key in labels.values()):
        long = long.withColumn(entity, F.col(entity).cast("int"))
    return long.where(F.col(value).isNotNull())


def pivot_wide(
    panel: DataFrame,
    entities: Sequence,
    *,
    date: str = "date",
    entity: str = "entity",
    value: str = "value",
) -> DataFrame:
    """One row per date, one column per listed entity; a cell is the mean of its values."""
    return panel.groupBy(date).pivot(entity, list(entities)).agg(F.avg(value))
