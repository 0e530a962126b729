"""Silver rules, in this order: readable key, first row per key, values in domain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import quoted
from tidemark.functions.values import lenient_date, lenient_number, within_domain


# Counter of a profile: lines that did not fit the header of their file.
MALFORMED = "malformed"


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where none of ``columns`` is NULL."""
    return df.where(reduce(Column.__and__, [F.col(name).isNotNull() for name in columns]))


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    *,
    few_keys: bool = False,
) -> DataFrame:
    """One row per key: the first in ``order_by``, which has to be a total order.

    Each task passes on at most one row per key (``WindowGroupLimit``, or a partial
    aggregate with ``few_keys``), so a key holding most of the rows does not travel whole.
    The window sorts the rows by key and order; with ``few_keys`` they are sorted by key
    alone and compared in passing, which is cheaper when a key has many rows.
    """
    if few_keys:
        named = [name for name in order_by if isinstance(name, str) and name not in keys]
        others = [name for name in df.columns if name not in keys and name not in named]
        order = F.struct(*order_by)
        kept = df.groupBy(*keys).agg(
            F.min_by(F.struct(*[F.col(quoted(name)) for name in others]), order).alias("_row"),
            F.min(order).alias("_order"),
        )
        source = {**dict.fromkeys(others, "_row"), **dict.fromkeys(named, "_order")}
        return kept.select(
            *[
                F.col(source[name])[name].alias(name) if name in source else F.col(quoted(name))
                for name in df.columns
            ]
        )
    place = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every column is missing or not negative."""
    return df.where(within_domain(list(columns)))


def clean(
    df: DataFrame, *, key: str, measures: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """The three Silver rules on a typed frame with many rows per key.

    A key disappears when its first row breaks the domain rule, although a later
    duplicate may not: the rules apply one after the other.
    """
    firsts = keep_first(drop_missing(df, key), [key], order_by, few_keys=True)
    return non_negative(firsts, measures)


def cleaning_profile(
    raw: DataFrame,
    *,
    date: str,
    measures: Sequence[str],
    order_by: Column | str,
    corrupt: str | None = None,
    within: Column | str | None = None,
) -> DataFrame:
    """One row per readable date (NULL: all unreadable ones) of a raw text frame.

    It holds the counters every report on cleaning needs and the values of the first row
    of the date, so one scan and one pre-aggregated shuffle serve funnel, quality report
    and Silver alike. With a whole-number ``order_by`` the aggregate needs no sort (its
    buffers have a fixed width); any other order is compared once per row for all measures,
    and the aggregate sorts the rows of a task. ``within`` comes before a whole-number order and
    has few values, such as the splits of the files that were read: rows are aggregated by date and
    ``within`` without a sort, and only what that leaves is compared by both.
    Rows without an order come first, as they do when sorted. ``corrupt`` names a column that
    is present in malformed rows alone; they are counted, and treated like all others.
    """
    order = F.col(order_by) if isinstance(order_by, str) else order_by
    if isinstance(within, str):
        within = F.col(within)
    # Read every value once, ahead of the aggregate that uses it several times.
    read = raw.select(
        lenient_date(F.col(date)).alias("_day"),
        F.col(date).isNotNull().alias("_dated"),
        *[lenient_number(F.col(name)).alias(f"_number:{name}") for name in measures],
        *[F.col(name).isNotNull().alias(f"_given:{name}") for name in measures],
        order.alias("_order"),
        *([F.col(corrupt).isNotNull().alias("_corrupt")] if corrupt else []),
        *([within.alias("_within")] if within is not None else []),
    )
    day, dated = F.col("_day"), F.col("_dated")
    counters = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~dated).alias(f"null_in:{date}"),
        F.count_if(dated & day.isNull()).alias(f"unparseable:{date}"),
        *([F.count_if(F.col("_corrupt")).alias(MALFORMED)] if corrupt else []),
    ]
    numbers = {name: F.col(f"_number:{name}") for name in measures}
    for name, number in numbers.items():
        given = F.col(f"_given:{name}")
        counters += [
            F.count_if(~given).alias(f"null_in:{name}"),
            F.count_if(given & number.isNull()).alias(f"unparseable:{name}"),
            F.count_if(number < 0).alias(f"negative:{name}"),
        ]
    by_date = read.groupBy(day.alias(date))
    whole = isinstance(read.schema["_order"].dataType, T.IntegralType)
    if within is not None and not whole:
        raise ValueError("within needs a whole-number order_by")
    place = F.coalesce(F.col("_order").cast("long"), F.lit(-(2**63))) if whole else None
    if within is not None:
        firsts = [F.min_by(number, place).alias(f"_first:{name}") for name, number in numbers.items()]
        parts = read.groupBy(day.alias(date), "_within").agg(*counters, *firsts, F.min(place).alias("_place"))
        names = [name for name in parts.columns if name not in (date, "_within", "_place") and not name.startswith("_first:")]
        values = F.struct(*[F.col(quoted(f"_first:{name}")).alias(name) for name in numbers])
        return (
            parts.groupBy(date)
            .agg(*[F.sum(F.col(quoted(name))).alias(name) for name in names], F.min_by(values, F.struct("_within", "_place")).alias("_first"))
            .select("*", "_first.*")
            .drop("_first")
        )
    if whole:
        firsts = [F.min_by(number, place).alias(name) for name, number in numbers.items()]
        return by_date.agg(*counters, *firsts)
    values = F.struct(*[number.alias(name) for name, number in numbers.items()])
    return (
        by_date.agg(*counters, F.min_by(values, F.struct("_order")).alias("_first"))
        .select("*", "_first.*")
        .drop("_first")
    )


def merged_profiles(
    profiles: DataFrame,
    *,
    date: str,
    measures: Sequence[str],
    order_by: str,
    keep_order: bool = False,
) -> DataFrame:
    """Profiles of several loads, a row per date and load, as the profile of all of them.

    Counters add up; the first row of a date is that of its earliest load by ``order_by``, which
    ``keep_order`` keeps. All is combined before it is shuffled.
    """
    counters = [name for name in profiles.columns if name == "n_rows" or name == MALFORMED or ":" in name]
    values = F.struct(*[F.col(quoted(name)) for name in measures])
    merged = profiles.groupBy(date).agg(
        *[F.sum(F.col(quoted(name))).alias(name) for name in counters],
        F.min_by(values, F.col(order_by)).alias("_first"),
        *([F.min(order_by).alias(order_by)] if keep_order else []),
    )
    return merged.select("*", "_first.*").drop("_first")


def survivors(profile: DataFrame, *, date: str, measures: Sequence[str]) -> DataFrame:
    """Silver rows ``(date, measures)`` of a cleaning profile."""
    kept = profile.where(F.col(date).isNotNull() & within_domain(list(measures)))
    return kept.select(date, *measures)


def cleaning_funnel(profile: DataFrame, *, date: str, measures: Sequence[str]) -> DataFrame:
    """``(step, rule, rows_in, rows_dropped, rows_out)``; each drop counted for one rule.

    A profile that counts malformed rows has a step 0 that tells their number; being
    malformed drops no row.
    """
    flagged = MALFORMED in profile.columns
    dated = F.col(date).isNotNull()
    totals = profile.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("all_rows"),
        F.coalesce(F.sum(F.when(~dated, F.col("n_rows"))), F.lit(0)).alias("undated"),
        F.count_if(dated).alias("dates"),
        F.count_if(dated & ~within_domain(list(measures))).alias("negative"),
        *([F.coalesce(F.sum(MALFORMED), F.lit(0)).alias(MALFORMED)] if flagged else []),
    )
    readable = F.col("all_rows") - F.col("undated")
    kept = F.col("dates") - F.col("negative")
    steps = [
        ("valid_date", F.col("all_rows"), F.col("undated"), readable),
        ("first_per_date", readable, readable - F.col("dates"), F.col("dates")),
        ("non_negative", F.col("dates"), F.col("negative"), kept),
    ]
    first = 1
    if flagged:
        first = 0
        steps.insert(0, ("malformed_kept", F.col(MALFORMED), F.lit(0).cast("long"), F.col(MALFORMED)))
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(step).alias("step"),
                        F.lit(rule).alias("rule"),
                        rows_in.alias("rows_in"),
                        dropped.alias("rows_dropped"),
                        rows_out.alias("rows_out"),
                    )
                    for step, (rule, rows_in, dropped, rows_out) in enumerate(steps, start=first)
                ]
            )
        )
    )
