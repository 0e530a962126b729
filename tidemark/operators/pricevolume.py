"""Prices beside volumes.

Two panels meet on period and entity, and neither side loses a row. The full outer join is written
as the union of both and one aggregate: rows are combined in the tasks that read them, so an
entity or a period with very many raw rows is one row per cell and task in the only shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.change import require_calendar
from tidemark.operators.reshape import cell_sums


def unit_prices(
    df: DataFrame,
    *,
    date: Column,
    entity: Column,
    amount: Column,
    quantity: Column,
    decimals: int = 2,
    grain: str = "month",
    tasks: int | None = None,
) -> DataFrame:
    """``(date, entity, price)``: money by quantity, both summed exactly to ``decimals`` digits.

    Rows without date, entity, amount or quantity take no part; a cell of quantity 0 has no price.
    ``tasks`` is for nearly as many cells as rows, see ``cell_sums``.
    """
    day = date.cast("date")
    unit = 10**decimals
    rows = df.select(
        (day if grain == "day" else F.trunc(day, grain)).alias("date"),
        entity.alias("entity"),
        F.rint(amount.cast("double") * unit).cast("long").alias("_amount"),
        F.rint(quantity.cast("double") * unit).cast("long").alias("_quantity"),
    ).dropna()
    sums = cell_sums(rows, ["_amount", "_quantity"], tasks)
    price = F.try_divide(F.col("_amount").cast("double"), F.col("_quantity").cast("double"))
    return sums.select("date", "entity", price.alias("price"))


def match_volumes(
    prices: DataFrame,
    volumes: DataFrame,
    *,
    date: str = "date",
    entity: str = "entity",
    price: str = "price",
    volume: str = "volume",
) -> DataFrame:
    """``(date, entity, price, volume, side)``: every cell that has a price, a volume or both.

    ``side`` is ``both``, ``price_only`` or ``volume_only``. Several rows of a cell count with their mean price
    and the sum of their volumes; NULL is no price and no volume. A row without date or entity
    meets nothing, as in a join, and is reported on its own side.
    """
    none = F.lit(None).cast("double")
    keys = [F.col(date).alias("date"), F.col(entity).alias("entity")]
    left = prices.where(F.col(price).isNotNull()).select(*keys, F.col(price).cast("double").alias("price"), none.alias("volume"))
    right = volumes.where(F.col(volume).isNotNull()).select(*keys, none.alias("price"), F.col(volume).cast("double").alias("volume"))
    both = left.unionByName(right)
    apart = F.when(F.col("date").isNull() | F.col("entity").isNull(), F.col("price").isNotNull())
    cells = both.groupBy("date", "entity", apart.alias("_apart")).agg(F.avg("price").alias("price"), F.sum("volume").alias("volume"))
    side = (
        F.when(F.col("price").isNull(), "volume_only").when(F.col("volume").isNull(), "price_only").otherwise("both")
    )
    return cells.select(F.col("date").alias(date), F.col("entity").alias(entity), F.col("price").alias(price), F.col("volume").alias(volume), side.alias("side"))


def unmatched(matched: DataFrame, *, date: str = "date", volume: str = "volume") -> DataFrame:
    """``(date, side, n_entities, volume, volume_pct)`` of the cells that lack the other side.

    ``volume_pct`` is the part of the period's whole volume that has no price; NULL for the cells
    that lack a volume. Periods of which all is matched have no row.
    """
    sums = matched.groupBy(date).agg(
        F.count_if(F.col("side") == "price_only").alias("_price_only"),
        F.count_if(F.col("side") == "volume_only").alias("_volume_only"),
        F.sum(F.when(F.col("side") == "volume_only", F.col(volume))).alias("_lost"),
        F.sum(volume).alias("_all"),
    )
    none = F.lit(None).cast("double")
    entries = [
        F.struct(F.lit("price_only").alias("side"), F.col("_price_only").alias("n_entities"), none.alias("volume"), none.alias("volume_pct")),
        F.struct(
            F.lit("volume_only").alias("side"),
            F.col("_volume_only").alias("n_entities"),
            F.col("_lost").alias("volume"),
            (F.try_divide(F.col("_lost"), F.col("_all")) * 100).alias("volume_pct"),
        ),
    ]
    return sums.select(date, F.inline(F.array(*entries))).where("n_entities > 0")


def weighted_index(
    matched: DataFrame,
    base: DataFrame | None = None,
    *,
    date: str = "date",
    entity: str = "entity",
    price: str = "price",
    volume: str = "volume",
) -> DataFrame:
    """One row per period: what the matched volume cost, beside the same volume at base prices.

    ``(date, n_entities, volume, turnover, unit_value, index_100, matched_pct)``. ``base`` has the entity and its base
    price; without it an entity's base is its first matched price. Cells without a base price
    count for volume and turnover, not for the index. ``matched_pct`` is the part of the period's
    volume that has a price.
    """
    require_calendar(matched, date)
    pays = (F.col("side") == "both").alias("_pays")
    cells = matched.select(F.col(date), F.col(entity), F.col(price).alias("_p"), F.col(volume).alias("_v"), pays)
    if base is None:
        history = Window.partitionBy(entity).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        first = F.first(F.when(F.col("_pays"), F.col("_p")), ignorenulls=True).over(history)
        cells = cells.withColumn("_base", first)
    else:
        (named,) = [name for name in base.columns if name != entity]
        known = base.groupBy(entity).agg(F.avg(named).alias("_base"))
        cells = cells.join(known, entity, "left")
    cost = F.when(F.col("_pays"), F.col("_p") * F.col("_v"))
    based = F.col("_pays") & F.col("_base").isNotNull()
    sums = cells.groupBy(date).agg(
        F.count_if(F.col("_pays")).alias("n_entities"),
        F.sum(F.when(F.col("_pays"), F.col("_v"))).alias("volume"),
        F.sum(cost).alias("turnover"),
        F.sum(F.when(based, cost)).alias("_now"),
        F.sum(F.when(based, F.col("_base") * F.col("_v"))).alias("_then"),
        F.sum("_v").alias("_all"),
    )
    return sums.select(
        date,
        "n_entities",
        "volume",
        "turnover",
        F.try_divide("turnover", "volume").alias("unit_value"),
        (F.try_divide("_now", "_then") * 100).alias("index_100"),
        (F.try_divide("volume", "_all") * 100).alias("matched_pct"),
    )
