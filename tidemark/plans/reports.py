"""The two reports: data quality and analysis."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.change import flag_outliers
from tidemark.operators.quality import quality_report
from tidemark.plans import answers
from tidemark.plans.layout import Layout
from tidemark.plans.medallion import Star


def analysis_report(star: Star, k: int = 5) -> DataFrame:
    """``(metric, entity, other, day, value)``: every headline result in one table."""
    lay = star.layout

    def part(df: DataFrame, metric: Column, value: str, other=None, day=None, name=lay.name):
        return df.select(
            metric.alias("metric"),
            F.col(name).alias("entity"),
            (F.lit(None) if other is None else F.col(other)).cast("string").alias("other"),
            (F.lit(None) if day is None else F.col(day)).cast("date").alias("day"),
            F.col(value).alias("value"),
        )

    pairs = answers.correlation(star).where("name_a < name_b")
    parts = [
        part(pairs, F.lit("correlation"), "corr", other="name_b", name="name_a"),
        part(answers.volatility_ranking(star), F.lit("volatility"), "volatility"),
        part(answers.extreme_moves(star, k), F.col("direction"), lay.change, day=lay.date),
        part(answers.benchmark_correlation(star), F.lit("benchmark_correlation"), "corr"),
        part(answers.growth_over_period(star), F.lit("growth"), "growth_pct"),
    ]
    return reduce(DataFrame.unionByName, parts)


def quality_of_load(profile: DataFrame, star: Star) -> DataFrame:
    """The quality report of a load: its profile, the Silver table and the outliers of Gold."""
    lay = star.layout
    flagged = flag_outliers(star.change, entity=lay.entity, change=lay.change)
    return quality_report(profile, flagged, date=lay.date, measures=lay.measures, output=star.silver)


def analysis_document(report: DataFrame, layout: Layout) -> DataFrame:
    """The analysis report as one row of named fields, ready for a JSON sink.

    It holds the entities of a literal dimension and the k extremes, which bounds what is
    gathered into the row. Percentages are rounded as they are presented. Of the layout's
    focus every pair has its correlation, and every name its growth and benchmark.
    """
    label = layout.labels
    pairs = list(combinations(sorted(layout.focus), 2))

    def named(metric: str, entity: str) -> str:
        return label.get(f"{metric}:{entity}", f"{metric}:{entity}")

    def only(metric: str, entity: str, digits: int, other: str | None = None) -> Column:
        rule = (F.col("metric") == metric) & (F.col("entity") == entity)
        if other is not None:
            rule = rule & (F.col("other") == other)
        return F.round(F.max(F.when(rule, F.col("value"))), digits)

    def moves(direction: str) -> Column:
        sign = -1 if direction == "rise" else 1
        listed = F.collect_list(
            F.when(
                F.col("metric") == direction,
                F.struct(
                    (F.col("value") * sign).alias("strength"),
                    F.col("day"),
                    F.col("entity"),
                    F.col("value"),
                ),
            )
        )
        return F.transform(
            F.array_sort(listed),
            lambda move: F.struct(
                move["day"].alias(layout.date),
                move["entity"].alias(layout.name),
                move["value"].alias(layout.change),
            ),
        )

    swings = F.collect_list(
        F.when(
            F.col("metric") == "volatility",
            F.struct(F.col("entity"), F.round("value", 2).alias("value")),
        )
    )
    return report.agg(
        *[
            only("correlation", first, 3, second).alias(named("correlation", f"{first}~{second}"))
            for first, second in pairs
        ],
        F.map_from_entries(swings).alias(label["volatility"]),
        moves("rise").alias(label["rises"]),
        moves("fall").alias(label["falls"]),
        *[
            only("benchmark_correlation", name, 3).alias(named("benchmark", name))
            for name in layout.focus
        ],
        *[only("growth", name, 1).alias(named("growth", name)) for name in layout.focus],
    )


def quality_document(report: DataFrame, layout: Layout) -> DataFrame:
    """The quality report as one row of named fields, ready for a JSON sink."""
    label = layout.labels

    def pick(dimension: str, stage: str, metric: str, column: str | None, field: str = "value"):
        rule = (
            (F.col("dimension") == dimension)
            & (F.col("stage") == stage)
            & (F.col("metric") == metric)
            & F.col("column").eqNullSafe(F.lit(column))
        )
        return F.max(F.when(rule, F.col(field)))

    def whole(column: Column) -> Column:
        return column.cast("bigint")

    def per_column(dimension: str, stage: str, metric: str, columns: list[str]) -> list[Column]:
        return [whole(pick(dimension, stage, metric, name)).alias(name) for name in columns]

    columns = [layout.date, *layout.measures]
    undated = [
        pick("completeness", "input", what, layout.date) for what in ("missing", "unparseable")
    ]
    dateless = whole(pick("completeness", "output", "missing", layout.date))
    return report.agg(
        F.struct(*per_column("completeness", "input", "missing", columns)).alias(
            label["missing_in"]
        ),
        F.struct(
            *per_column("completeness", "output", "missing", columns),
            dateless.alias(layout.year),
            dateless.alias(layout.month),
        ).alias(label["missing_out"]),
        whole(pick("uniqueness", "input", "surplus_rows", layout.date)).alias(label["surplus"]),
        whole(undated[0] + undated[1]).alias(label["undated"]),
        F.struct(*per_column("accuracy", "input", "negative", layout.measures)).alias(
            label["negative"]
        ),
        F.struct(
            pick("coverage", "output", "first", layout.date, "day").alias(label["first"]),
            pick("coverage", "output", "last", layout.date, "day").alias(label["last"]),
        ).alias(label["coverage"]),
        whole(pick("consistency", "input", "rows", None)).alias(label["rows_in"]),
        whole(pick("consistency", "output", "rows", None)).alias(label["rows_out"]),
    )
