"""Data quality in five dimensions, plus coverage.

Every check over columns is one aggregate over one scan, whatever the number of columns;
only uniqueness shuffles (its key counts), and it combines before it does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import pct_of, within_domain
from tidemark.operators.cleaning import MALFORMED


def _present_rows() -> Column:
    return F.count(F.lit(1))


def _missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    if df.schema[name].dataType.typeName() in ("double", "float"):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def _rows(totals: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn a one-row frame of totals into one row per struct."""
    return totals.select(F.inline(F.array(*structs)))


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n_rows, n_missing, missing_pct)``; the share of an empty table is NULL."""
    totals = df.agg(
        _present_rows().alias("n_rows"),
        *[F.count_if(_missing(df, name)).alias(f"missing:{name}") for name in columns],
    )
    return _rows(
        totals,
        [
            F.struct(
                F.lit(name).alias("column"),
                F.col("n_rows"),
                F.col(f"missing:{name}").alias("n_missing"),
                pct_of(F.col(f"missing:{name}"), F.col("n_rows")).alias("missing_pct"),
            )
            for name in columns
        ],
    )


def _kept(date: str, measures: Sequence[str]) -> Column:
    """The rows of a cleaning profile that survive it."""
    return F.col(date).isNotNull() & within_domain(list(measures))


def _total(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def missing_by_stage(profile: DataFrame, *, date: str, measures: Sequence[str]) -> DataFrame:
    """``(stage, column, n_missing, n_unparseable)`` of the text input and of the output.

    Text that cannot be read is counted apart from absent values, so a rise in missing
    values between the stages is explained. Both stages are totals over a cleaning profile.
    """
    columns = [date, *measures]
    kept = _kept(date, measures)
    totals = profile.agg(
        *[_total(F.col(f"null_in:{name}")).alias(f"null_in:{name}") for name in columns],
        *[_total(F.col(f"unparseable:{name}")).alias(f"unparseable:{name}") for name in columns],
        *[F.count_if(kept & F.col(name).isNull()).alias(f"null_out:{name}") for name in columns],
    )

    def entry(stage: str, name: str, missing: str, unreadable: Column) -> Column:
        return F.struct(
            F.lit(stage).alias("stage"),
            F.lit(name).alias("column"),
            F.col(f"{missing}:{name}").alias("n_missing"),
            unreadable.cast("bigint").alias("n_unparseable"),
        )

    return _rows(
        totals,
        [entry("input", name, "null_in", F.col(f"unparseable:{name}")) for name in columns]
        + [entry("output", name, "null_out", F.lit(0)) for name in columns],
    )


def consistency(profile: DataFrame, *, date: str, measures: Sequence[str]) -> DataFrame:
    """One row: rows in, rows out, rows discarded, absent and unreadable dates in the input."""
    totals = profile.agg(
        _total(F.col("n_rows")).alias("rows_in"),
        _total(F.col(f"null_in:{date}")).alias("absent_dates"),
        _total(F.col(f"unparseable:{date}")).alias("unreadable_dates"),
        F.count_if(_kept(date, measures)).alias("rows_out"),
    )
    return totals.withColumn("rows_discarded", F.col("rows_in") - F.col("rows_out"))


def uniqueness(stages: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """``(stage, n_rows, duplicated_keys, surplus_rows)`` of each stage's table.

    Rows without a key form one group, as they do in a deduplication. Every stage's own rows are
    counted by key: an output is measured, not taken to be unique.
    """
    counted = []
    for stage, df in stages.items():
        sizes = df.groupBy(*keys).agg(_present_rows().alias("_size"))
        totals = sizes.agg(
            _total(F.col("_size")).alias("n_rows"),
            F.count_if(F.col("_size") > 1).alias("duplicated_keys"),
            _total(F.col("_size") - 1).alias("surplus_rows"),
        )
        counted.append(totals.select(F.lit(stage).alias("stage"), "*"))
    return reduce(DataFrame.unionByName, counted)


def accuracy(df: DataFrame, columns: Sequence[str], stage: str = "input") -> DataFrame:
    """``(stage, column, n_negative)``: values below zero."""
    totals = df.agg(*[F.count_if(F.col(name) < 0).alias(name) for name in columns])
    return _rows(
        totals,
        [
            F.struct(
                F.lit(stage).alias("stage"),
                F.lit(name).alias("column"),
                F.col(name).alias("n_negative"),
            )
            for name in columns
        ],
    )


def coverage(df: DataFrame, date: str = "date") -> DataFrame:
    """One row: first and last date."""
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def quality_report(
    profile: DataFrame,
    outliers: DataFrame,
    *,
    date: str,
    measures: Sequence[str],
    output: DataFrame | None = None,
) -> DataFrame:
    """All dimensions in one table: ``(dimension, stage, column, metric, value, day)``.

    ``profile`` is a cleaning profile: the five dimensions are totals over its rows, so
    the raw input is read once. ``output`` is the cleaned table as written, whose uniqueness is
    counted on its own rows. ``day`` holds the dates of the coverage, ``value`` all other results.
    """
    kept = _kept(date, measures)
    inputs = [date, *measures]
    total = _total
    counts_malformed = MALFORMED in profile.columns
    totals = profile.agg(
        total(F.col("n_rows")).alias("rows_in"),
        F.count_if(kept).alias("rows_out"),
        F.count_if(F.col("n_rows") > 1).alias("duplicated_keys"),
        total(F.col("n_rows") - 1).alias("surplus_rows"),
        F.min(F.when(kept, F.col(date))).alias("first_date"),
        F.max(F.when(kept, F.col(date))).alias("last_date"),
        *([total(F.col(MALFORMED)).alias(MALFORMED)] if counts_malformed else []),
        *[total(F.col(f"null_in:{name}")).alias(f"null_in:{name}") for name in inputs],
        *[total(F.col(f"unparseable:{name}")).alias(f"unparseable:{name}") for name in inputs],
        *[total(F.col(f"negative:{name}")).alias(f"negative:{name}") for name in measures],
        *[F.count_if(kept & F.col(name).isNull()).alias(f"null_out:{name}") for name in inputs],
        *[F.count_if(kept & (F.col(name) < 0)).alias(f"negative_out:{name}") for name in measures],
    )

    def entry(dimension, stage, column, metric, value=None, day=None) -> Column:
        return F.struct(
            F.lit(dimension).alias("dimension"),
            F.lit(stage).alias("stage"),
            F.lit(column).cast("string").alias("column"),
            F.lit(metric).alias("metric"),
            (F.lit(None) if value is None else value).cast("double").alias("value"),
            (F.lit(None) if day is None else day).cast("date").alias("day"),
        )

    entries = []
    for name in inputs:
        entries.append(entry("completeness", "input", name, "missing", F.col(f"null_in:{name}")))
        entries.append(
            entry("completeness", "input", name, "unparseable", F.col(f"unparseable:{name}"))
        )
        missing = F.col(f"null_out:{name}")
        entries.append(entry("completeness", "output", name, "missing", missing))
        entries.append(
            entry(
                "completeness",
                "output",
                name,
                "missing_pct",
                pct_of(missing, F.col("rows_out")),
            )
        )
    discarded = F.col("rows_in") - F.col("rows_out")
    entries += [
        entry("consistency", "input", None, "rows", F.col("rows_in")),
        entry("consistency", "output", None, "rows", F.col("rows_out")),
        entry("consistency", "output", None, "rows_discarded", discarded),
        entry("uniqueness", "input", date, "duplicated_keys", F.col("duplicated_keys")),
        entry("uniqueness", "input", date, "surplus_rows", F.col("surplus_rows")),
        entry("coverage", "output", date, "first", day=F.col("first_date")),
        entry("coverage", "output", date, "last", day=F.col("last_date")),
    ]
    if counts_malformed:
        entries.append(entry("consistency", "input", None, "malformed_rows", F.col(MALFORMED)))
    for name in measures:
        entries.append(entry("accuracy", "input", name, "negative", F.col(f"negative:{name}")))
        entries.append(
            entry("accuracy", "output", name, "negative", F.col(f"negative_out:{name}"))
        )
    flagged = outliers.agg(_present_rows().alias("n"))
    report = _rows(totals, entries).unionByName(
        _rows(flagged, [entry("outliers", "output", None, "beyond_sigmas", F.col("n"))])
    )
    if output is None:
        return report
    unique = uniqueness({"output": output}, [date])
    found = [entry("uniqueness", "output", date, name, F.col(name)) for name in ("duplicated_keys", "surplus_rows")]
    return report.unionByName(_rows(unique, found))
