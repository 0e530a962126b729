"""The five questions asked of the star schema, as tables.

Names come from the dimension by an inner join; results that are presented in an order
have a total one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.change import flag_outliers, growth, rebase
from tidemark.operators.dimension import name_entities
from tidemark.operators.projection import seasonal, trend
from tidemark.operators.ranking import extremes, largest_first
from tidemark.operators.relation import correlation_matrix, correlation_with_benchmark
from tidemark.operators.summary import peak_period, volatility
from tidemark.plans.medallion import Star


def _focus(star: Star, names: Sequence[str] | None):
    chosen = star.layout.focus if names is None else names
    return F.col(star.layout.name).isin(list(chosen))


def _presented(df: DataFrame, column: str, digits: int | None) -> DataFrame:
    """Rounded half up to the digits shown, if any are given."""
    return df if digits is None else df.withColumn(column, F.round(column, digits))


def evolution(star: Star, names: Sequence[str] | None = None) -> DataFrame:
    """Question 1: the chosen entities' values over time."""
    lay = star.layout
    chosen = name_entities(star.monthly, star.dimension, lay.entity, _focus(star, names))
    return chosen.select(lay.date, lay.name, lay.value).orderBy(lay.date, lay.name)


def correlation(star: Star) -> DataFrame:
    """Question 2: correlation of every pair, ``(name_a, name_b, corr, n)``."""
    lay = star.layout
    pairs = correlation_matrix(star.monthly, **lay.grain)
    names = star.dimension.select(lay.entity, lay.name)
    left = names.toDF("entity_a", "name_a")
    right = names.toDF("entity_b", "name_b")
    return pairs.join(left, "entity_a").join(right, "entity_b").select(
        "name_a", "name_b", "corr", "n"
    )


def correlation_wide(star: Star, digits: int | None = None) -> DataFrame:
    """Question 2 as a square table: one row and one column per entity of the layout."""
    names = [row[star.layout.name] for row in star.layout.entities]
    pairs = _presented(correlation(star), "corr", digits)
    return pairs.groupBy("name_a").pivot("name_b", names).agg(F.max("corr"))


def volatility_ranking(star: Star, digits: int | None = None) -> DataFrame:
    """Question 3: deviation of the monthly changes per entity, highest first."""
    lay = star.layout
    overall = volatility(star.change, [lay.entity], change=lay.change)
    named = name_entities(overall, star.dimension, lay.entity)
    ranked = named.select(lay.name, "volatility").orderBy(F.desc("volatility"), lay.name)
    return _presented(ranked, "volatility", digits)


def volatility_by_year(star: Star, names: Sequence[str] | None = None) -> DataFrame:
    """Question 3: the same within each year, for the chosen entities."""
    lay = star.layout
    chosen = name_entities(star.change, star.dimension, lay.entity, _focus(star, names))
    return volatility(chosen, [lay.year, lay.name], change=lay.change)


def volatility_peak(star: Star) -> DataFrame:
    """Question 3: the year in which each entity was most volatile."""
    lay = star.layout
    yearly = volatility(star.change, [lay.year, lay.entity], change=lay.change)
    peaks = peak_period(yearly, period=lay.year, entity=lay.entity)
    named = name_entities(peaks, star.dimension, lay.entity)
    return named.select(lay.name, f"peak_{lay.year}", "peak_volatility")


def benchmark_correlation(star: Star) -> DataFrame:
    """Question 4: correlation of each entity with the benchmark."""
    lay = star.layout
    index = star.silver.select(lay.date, lay.benchmark)
    related = correlation_with_benchmark(star.monthly, index, **lay.grain)
    return name_entities(related, star.dimension, lay.entity).select(lay.name, "corr", "n")


def rebased(star: Star, names: Sequence[str] | None = None) -> DataFrame:
    """Question 4: the chosen entities and the benchmark, each with its start at 100."""
    lay = star.layout
    chosen = name_entities(star.monthly, star.dimension, lay.entity, _focus(star, names))
    series = chosen.select(lay.date, lay.name, lay.value).unionByName(
        star.silver.select(
            lay.date, F.lit(lay.benchmark).alias(lay.name), F.col(lay.benchmark).alias(lay.value)
        )
    )
    return rebase(series, date=lay.date, entity=lay.name, value=lay.value)


def extreme_moves(star: Star, k: int = 5, digits: int | None = None) -> DataFrame:
    """Question 5: the largest rises and falls."""
    lay = star.layout
    top = extremes(star.change, k=k, change=lay.change, ties=(lay.date, lay.entity))
    named = name_entities(top, star.dimension, lay.entity).select(
        "direction", "rank", lay.date, lay.name, lay.change
    )
    return _presented(named, lay.change, digits)


def outlying_moves(star: Star, sigmas: float = 3.0) -> DataFrame:
    """Changes beyond the given number of deviations, largest first."""
    lay = star.layout
    flagged = flag_outliers(star.change, entity=lay.entity, change=lay.change, sigmas=sigmas)
    named = name_entities(flagged, star.dimension, lay.entity)
    columns = named.select(lay.date, lay.name, lay.value, lay.change)
    return largest_first(columns, lay.change, lay.date, lay.name)


def growth_over_period(star: Star) -> DataFrame:
    """First and last value of each entity and the growth between them."""
    lay = star.layout
    ends = growth(star.monthly, **lay.grain)
    return name_entities(ends, star.dimension, lay.entity).select(
        lay.name, "first_value", "last_value", "growth_pct"
    )


def projection(
    star: Star, horizon: int = 6, grain: str = "month", names: Sequence[str] | None = None
) -> DataFrame:
    """What comes next: the chosen entities' trend, with its band, past the last observation."""
    lay = star.layout
    chosen = name_entities(star.monthly, star.dimension, lay.entity, _focus(star, names))
    return trend(chosen, horizon=horizon, grain=grain, date=lay.date, entity=lay.name, value=lay.value)


def seasonal_projection(
    star: Star, horizon: int = 12, season: int = 12, grain: str = "month", names: Sequence[str] | None = None
) -> DataFrame:
    """What comes next if the chosen entities' last season is repeated."""
    lay = star.layout
    chosen = name_entities(star.monthly, star.dimension, lay.entity, _focus(star, names))
    return seasonal(
        chosen, horizon=horizon, season=season, grain=grain, date=lay.date, entity=lay.name, value=lay.value
    )
