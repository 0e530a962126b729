"""Bronze -> Silver -> Gold, as lazy layers and as a job with one write per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import quoted
from tidemark.operators.change import mom_change
from tidemark.operators.cleaning import (
    cleaning_profile,
    drop_missing,
    keep_first,
    non_negative,
    survivors,
)
from tidemark.operators.conform import calendar_parts, conform, typed
from tidemark.operators.dimension import literal_dimension
from tidemark.operators.ingest import (
    ROW_ID,
    locate,
    number_rows,
    rename_audit,
    rename_to_technical,
    source_order,
    stamp,
)
from tidemark.operators.reshape import unpivot_long
from tidemark.operators.summary import annual_stats
from tidemark.plans.layout import COMMODITIES, Layout
from tidemark.session import shared_folder
from tidemark.sources.readers import BLOCK, CORRUPT, FILE, read_csv
from tidemark.sources.sinks import ensure_schema, overwrite_table, replace_table


def bronze(raw: DataFrame, source: str | None = None) -> DataFrame:
    """The raw rows under technical names, with load time and source.

    Without ``source`` it is the path of each row's file. Where the order of the rows
    matters later, ``locate`` and ``number_rows`` record it when they are stored.
    """
    return stamp(rename_to_technical(raw), source)


def _conformed(
    bronze_rows: DataFrame, layout: Layout, order_by: Sequence[Column] | None
) -> DataFrame:
    """The layout's columns as text, ``_position``, the order of the rows, and malformed text.

    Without ``order_by`` the order is that of the raw files, as recorded on ingestion: their
    paths, and the places in them.
    """
    if order_by:
        position = order_by[0] if len(order_by) == 1 else F.struct(*order_by)
    elif ROW_ID in bronze_rows.columns:
        position = source_order()
    else:
        raise ValueError("rows without recorded places need an order_by")
    corrupt = F.col(CORRUPT) if CORRUPT in bronze_rows.columns else F.lit(None).cast("string")
    placed = bronze_rows.withColumns({"_position": position, CORRUPT: corrupt})
    return conform(placed, {**layout.mapping, "_position": "_position", CORRUPT: CORRUPT})


def _split() -> Column:
    """The part of ``source_order`` before a row's number: the split it was read from."""
    return F.struct(*[F.col(f"_position.{name}").alias(name) for name in (FILE, BLOCK)])


def silver(
    bronze_rows: DataFrame, layout: Layout, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """Selected, typed and cleaned columns with year and month.

    Of rows with the same date the first survives: first in ``order_by`` if given,
    otherwise first as ingested.
    """
    rows = first_rows(bronze_rows, layout, order_by)
    return calendar_parts(
        non_negative(rows, layout.measures), layout.date, year=layout.year, month=layout.month
    )


def first_rows(
    bronze_rows: DataFrame, layout: Layout, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """The typed first row of every date, in domain or not."""
    chosen = _conformed(bronze_rows, layout, order_by).drop(CORRUPT)
    dated = drop_missing(typed(chosen, dates=[layout.date]), layout.date)
    # Only the date decides which row of a date stays: numbers are read from those alone.
    firsts = keep_first(dated, [layout.date], ["_position"], few_keys=True).drop("_position")
    return typed(firsts, numbers=layout.measures)


def load_profile(
    bronze_rows: DataFrame, layout: Layout, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """The cleaning profile of Bronze: counters and first row per date, from one scan."""
    return cleaning_profile(
        _conformed(bronze_rows, layout, order_by),
        date=layout.date,
        measures=layout.measures,
        order_by="_position" if order_by else f"_position.{ROW_ID}",
        corrupt=CORRUPT if CORRUPT in bronze_rows.columns else None,
        within=None if order_by else _split(),
    )


def silver_of(profile: DataFrame, layout: Layout) -> DataFrame:
    """The same Silver rows as ``silver``, taken from a profile."""
    rows = survivors(profile, date=layout.date, measures=layout.measures)
    return calendar_parts(rows, layout.date, year=layout.year, month=layout.month)


def dimension(
    spark: SparkSession, layout: Layout, described: Mapping[str, Mapping] | None = None
) -> DataFrame:
    """One row per entity.

    ``described`` adds descriptive columns: column -> {entity name: value}.
    """
    rows = [
        {**row, **{column: values.get(row[layout.name]) for column, values in (described or {}).items()}}
        for row in layout.entities
    ]
    return literal_dimension(spark, rows, layout.entity)


def monthly(silver_rows: DataFrame, layout: Layout) -> DataFrame:
    """The fact at the grain date x entity."""
    ids = [layout.date, layout.year, layout.month]
    long = unpivot_long(
        silver_rows,
        ids=ids,
        measures=layout.entity_columns,
        entity=layout.entity,
        value=layout.value,
    )
    return long.select(*ids, layout.entity, layout.value)


def annual(monthly_rows: DataFrame, layout: Layout) -> DataFrame:
    """Mean, minimum, maximum and deviation per year and entity."""
    return annual_stats(
        monthly_rows,
        year=layout.year,
        entity=layout.entity,
        value=layout.value,
        names=layout.stats,
    )


def change(monthly_rows: DataFrame, layout: Layout) -> DataFrame:
    """Percent change from the previous observation."""
    return mom_change(monthly_rows, **layout.grain, change=layout.change).select(
        layout.date, layout.year, layout.month, layout.entity, layout.value, layout.change
    )


@dataclass(frozen=True)
class Star:
    """The tables the answers read."""

    layout: Layout
    silver: DataFrame
    dimension: DataFrame
    monthly: DataFrame
    annual: DataFrame
    change: DataFrame
    profile: DataFrame | None = None

    @classmethod
    def derive(cls, spark: SparkSession, silver_rows: DataFrame, layout: Layout) -> Star:
        """All Gold tables as lazy views of Silver."""
        facts = monthly(silver_rows, layout)
        return cls(
            layout=layout,
            silver=silver_rows,
            dimension=dimension(spark, layout),
            monthly=facts,
            annual=annual(facts, layout),
            change=change(facts, layout),
        )

    @classmethod
    def load(
        cls,
        spark: SparkSession,
        schema: str,
        layout: Layout = COMMODITIES,
        profile: DataFrame | None = None,
    ) -> Star:
        """The tables a job has written; ``schema`` is a qualified name."""
        tables = {
            layer: spark.table(f"{schema}.{quoted(table)}")
            for layer, table in layout.tables.items()
            if layer != "bronze"
        }
        return cls(layout=layout, profile=profile, **tables)


def run(
    spark: SparkSession,
    csv_path: str,
    *,
    schema: str,
    layout: Layout = COMMODITIES,
    catalog: str | None = None,
    source: str | None = None,
    fmt: str = "parquet",
    location: str | None = None,
    numbered: bool = True,
    partition_facts: bool = False,
    buckets: int = 0,
    order_by: Sequence[Column] | None = None,
    infer: bool = False,
    across_lines: bool = False,
    described: Mapping[str, Mapping] | None = None,
) -> Star:
    """Load a CSV file or folder and replace all tables of the layout.

    Each table is written by one job that reads the table before it. Bronze is read once:
    its profile, one row per date, is checkpointed and gives Silver as well as the quality
    report (``Star.profile``). Of rows with one date the first stays, by the path of the file
    and the place in it. ``numbered`` gives Bronze three more control columns that record
    both; without it they are taken from the raw files, which are then read a second time.
    Beside Bronze a table ``<bronze>_renamed`` lists the columns that have new names.

    ``source`` is a text to stamp on all rows, instead of the path of each row's file;
    ``infer`` gives Bronze the types that its values have; ``described`` adds columns to the
    dimension. ``partition_facts`` stores the monthly and change
    facts by year, which suits a choice of years; ``buckets`` stores them by entity in that
    many files, so that change, volatility, outliers and growth read them without a shuffle.
    ``location`` puts a new schema and its tables under a given folder, where every table is
    replaced in one step (``replace_table``) unless it is bucketed. ``across_lines`` reads values
    that hold line breaks.
    """
    qualified = ensure_schema(spark, schema, catalog, location)

    def put(table: str, df: DataFrame, **storage) -> DataFrame:
        name = f"{qualified}.{quoted(table)}"
        if location is None:
            overwrite_table(df, name, fmt=fmt, **storage)
        elif "bucket_by" in storage:
            overwrite_table(df, name, fmt=fmt, path=f"{location}/{table}", **storage)
        else:
            replace_table(df, name, f"{location}/{table}", fmt=fmt, **storage)
        return spark.table(name)

    def write(layer: str, df: DataFrame, **storage) -> DataFrame:
        return put(layout.tables[layer], df, **storage)

    stored = {"partition_by": (layout.year,)} if partition_facts else {}
    if buckets:
        stored |= {"bucket_by": layout.entity, "buckets": buckets, "sort_by": layout.date}
    scanned = read_csv(spark, csv_path, infer=infer, across_lines=across_lines)
    received = bronze(scanned, source)
    placed = number_rows(locate(received))
    raw = write("bronze", placed if numbered else received)
    put(f"{layout.tables['bronze']}_renamed", rename_audit(scanned))
    shared_folder(spark)
    ordered = raw if numbered or order_by else placed
    profile = load_profile(ordered, layout, order_by).checkpoint()
    rows = write("silver", silver_of(profile, layout))
    write("dimension", dimension(spark, layout, described))
    facts = write("monthly", monthly(rows, layout), **stored)
    write("annual", annual(facts, layout))
    write("change", change(facts, layout), **stored)
    return Star.load(spark, qualified, layout, profile)
