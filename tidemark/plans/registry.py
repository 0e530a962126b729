"""Every operator as a query over the given tables: name -> (session, folder) -> rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import lenient_date, lenient_number
from tidemark.operators import (
    change,
    cleaning,
    conform,
    dimension,
    ingest,
    pricevolume,
    projection,
    quality,
    ranking,
    relation,
    reshape,
    summary,
)
from tidemark.plans import answers, medallion, reports
from tidemark.plans.testbed import (
    PRIORITIES,
    SHIPMENTS,
    benchmark_price,
    dirty_orders,
    fact_priority,
    list_price_part,
    panel_brand,
    panel_customer,
    panel_event,
    panel_flag,
    panel_priority,
    panel_year,
    raw_shipments,
    shipment_order,
    table,
    unit_price_part,
    volume_part,
    wide_priority,
)
from tidemark.session import discard, scratch_path, shared_folder
from tidemark.sources.readers import BLOCK, FILE, ROW_ID, read_csv
from tidemark.sources.sinks import write_csv, write_json
from tidemark.streaming.events import EventWindows
from tidemark.streaming.refresh import Refresh

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


def _priority_dim(spark: SparkSession) -> DataFrame:
    rows = [{"entity_id": key, "entity_name": name} for key, name in PRIORITIES.items()]
    return dimension.literal_dimension(spark, rows, "entity_id")


def _shipments(spark: SparkSession, folder: str) -> medallion.Star:
    bronze = medallion.bronze(raw_shipments(spark, folder), "lineitem")
    rows = medallion.silver(bronze, SHIPMENTS, shipment_order())
    return medallion.Star.derive(spark, rows, SHIPMENTS)


# --- Bronze ---------------------------------------------------------------------------


@_query
def profile_shape(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.shape_profile(table(spark, folder, "orders"))


@_query
def normalise_names(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.rename_to_technical(raw_shipments(spark, folder))


@_query
def rename_audit(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.rename_audit(raw_shipments(spark, folder), counted=True)


@_query
def ingest_stamp(spark: SparkSession, folder: str) -> DataFrame:
    stamped = ingest.stamp(table(spark, folder, "orders"), "given:orders")
    return stamped.withColumn(
        "is_stamped", F.col("_ingestion_timestamp").isNotNull()
    ).drop("_ingestion_timestamp")


# --- Silver ---------------------------------------------------------------------------


@_query
def conform_select(spark: SparkSession, folder: str) -> DataFrame:
    mapping = {"o orderkey": "order_id", "o_orderdate": "day", "o_totalprice": "price"}
    return conform.conform(table(spark, folder, "orders"), mapping).withColumn(
        "day", F.to_date("day")
    )


@_query
def parse_date_lenient(spark: SparkSession, folder: str) -> DataFrame:
    rows = dirty_orders(spark, folder)
    return rows.select("o_orderkey", "raw_date", lenient_date(F.col("raw_date")).alias("day"))


@_query
def cast_numeric_lenient(spark: SparkSession, folder: str) -> DataFrame:
    rows = dirty_orders(spark, folder)
    return rows.select("o_orderkey", lenient_number(F.col("raw_price")).alias("price"))


@_query
def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date")
    )
    return conform.calendar_parts(rows)


def _typed_orders(spark: SparkSession, folder: str) -> DataFrame:
    named = conform.conform(
        dirty_orders(spark, folder),
        {"raw_date": "day", "raw_price": "price", "o_orderkey": "o_orderkey"},
    )
    return conform.typed(named, dates=["day"], numbers=["price"])


@_query
def clean_dates(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_missing(_typed_orders(spark, folder), "day")


@_query
def domain_nonnegative(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.non_negative(_typed_orders(spark, folder), ["price"])


@_query
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    others = [name for name in lines.columns if name not in ("l_orderkey", "l_linenumber")]
    return cleaning.keep_first(lines, ["l_orderkey", "l_linenumber"], others)


@_query
def clean_rules(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(
        _typed_orders(spark, folder), key="day", measures=["price"], order_by=["o_orderkey"]
    )


def _order_profile(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cleaning_profile(
        dirty_orders(spark, folder), date="raw_date", measures=["raw_price"], order_by="o_orderkey"
    )


@_query
def clean_survivors(spark: SparkSession, folder: str) -> DataFrame:
    profile = _order_profile(spark, folder)
    return cleaning.survivors(profile, date="raw_date", measures=["raw_price"])


@_query
def clean_funnel(spark: SparkSession, folder: str) -> DataFrame:
    profile = _order_profile(spark, folder)
    return cleaning.cleaning_funnel(profile, date="raw_date", measures=["raw_price"])


# --- Gold -----------------------------------------------------------------------------


@_query
def dim_entity(spark: SparkSession, folder: str) -> DataFrame:
    return dimension.entity_dimension(table(spark, folder, "customer"), "c_name")


@_query
def unpivot_long(spark: SparkSession, folder: str) -> DataFrame:
    measures = {f"p{key}": key for key in PRIORITIES}
    return reshape.unpivot_long(wide_priority(spark, folder), ids=["date"], measures=measures)


@_query
def pivot_wide(spark: SparkSession, folder: str) -> DataFrame:
    wide = reshape.pivot_wide(fact_priority(spark, folder), list(PRIORITIES), entity="entity_id")
    return wide.toDF("date", *[f"p{key}" for key in PRIORITIES])


@_query
def join_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dimension.name_entities(fact_priority(spark, folder), _priority_dim(spark))


@_query
def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    flags = panel_flag(spark, folder)
    events = panel_event(spark, folder).select("value", "entity", "date")
    return conform.union_sources(flags, events)


@_query
def benchmark_align(spark: SparkSession, folder: str) -> DataFrame:
    return relation.align_benchmark(panel_priority(spark, folder), benchmark_price(spark, folder))


@_query
def annual_stats(spark: SparkSession, folder: str) -> DataFrame:
    panel = conform.calendar_parts(panel_priority(spark, folder))
    stats = summary.annual_stats(panel)
    return _rounded(stats, 4, "mean_value", "sd_value")


@_query
def mom_change(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(change.mom_change(panel_priority(spark, folder)), 6, "change_pct")


@_query
def mom_change_customer(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(change.mom_change(panel_customer(spark, folder)), 6, "change_pct")


@_query
def daily_change_event(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(change.mom_change(panel_event(spark, folder)), 6, "change_pct")


@_query
def preview_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.preview(panel_priority(spark, folder), ["date", "entity"], 10)


# --- Answers --------------------------------------------------------------------------


@_query
def evolution_selected(spark: SparkSession, folder: str) -> DataFrame:
    chosen = F.col("entity_name").isin(PRIORITIES[1], PRIORITIES[2])
    named = dimension.name_entities(
        fact_priority(spark, folder), _priority_dim(spark), where=chosen
    )
    return named.select("date", "entity_name", "value").orderBy("date", "entity_name")


def _priority_moves(spark: SparkSession, folder: str) -> DataFrame:
    return conform.calendar_parts(change.mom_change(panel_priority(spark, folder)))


def _brand_moves(spark: SparkSession, folder: str) -> DataFrame:
    return change.mom_change(panel_brand(spark, folder), entity="entity_id")


@_query
def volatility_overall(spark: SparkSession, folder: str) -> DataFrame:
    overall = summary.volatility(_priority_moves(spark, folder), ["entity"])
    return _rounded(overall, 6, "volatility").orderBy(F.desc("volatility"), "entity")


@_query
def volatility_by_year(spark: SparkSession, folder: str) -> DataFrame:
    chosen = _priority_moves(spark, folder).where(
        F.col("entity").isin(PRIORITIES[1], PRIORITIES[2])
    )
    return _rounded(summary.volatility(chosen, ["year", "entity"]), 6, "volatility")


@_query
def volatility_peak_year(spark: SparkSession, folder: str) -> DataFrame:
    yearly = summary.volatility(_priority_moves(spark, folder), ["year", "entity"])
    return _rounded(summary.peak_period(yearly), 6, "peak_volatility")


@_query
def top_moves(spark: SparkSession, folder: str) -> DataFrame:
    top = ranking.extremes(_brand_moves(spark, folder), k=5, ties=("date", "entity_id"))
    return _rounded(top, 6, "change_pct").orderBy("direction", "rank")


@_query
def top_moves_per_entity(spark: SparkSession, folder: str) -> DataFrame:
    top = ranking.extremes_per_entity(_brand_moves(spark, folder), k=3, entity="entity_id")
    return _rounded(top, 6, "change_pct")


@_query
def outliers_3sigma(spark: SparkSession, folder: str) -> DataFrame:
    flagged = change.outliers(panel_brand(spark, folder), entity="entity_id")
    ordered = ranking.largest_first(flagged, "change_pct", "date", "entity_id")
    return _rounded(ordered, 6, "change_pct", "mean_change", "sd_change")


@_query
def outliers_customer(spark: SparkSession, folder: str) -> DataFrame:
    flagged = change.outliers(panel_customer(spark, folder))
    return _rounded(flagged, 6, "change_pct", "mean_change", "sd_change")


@_query
def rebase_100(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(change.rebase(panel_priority(spark, folder)), 6, "index_100")


@_query
def growth_period(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(change.growth(panel_priority(spark, folder)), 6, "growth_pct")


@_query
def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(relation.correlation_matrix(fact_priority(spark, folder)), 6, "corr")


@_query
def correlation_matrix_brand(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(relation.correlation_matrix(panel_brand(spark, folder)), 6, "corr")


@_query
def correlation_sparse(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(relation.correlation_matrix(panel_year(spark, folder)), 6, "corr")


@_query
def correlation_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    related = relation.correlation_with_benchmark(
        panel_priority(spark, folder), benchmark_price(spark, folder)
    )
    return _rounded(related, 6, "corr")


@_query
def seasonal_change(spark: SparkSession, folder: str) -> DataFrame:
    compared = projection.seasonal_change(panel_customer(spark, folder))
    return _rounded(compared, 6, "season_change_pct")


@_query
def projection_trend(spark: SparkSession, folder: str) -> DataFrame:
    lines = projection.trend(panel_brand(spark, folder), entity="entity_id")
    return _rounded(lines, 4, "slope", "residual_sd", "projected", "low", "high")


@_query
def projection_seasonal(spark: SparkSession, folder: str) -> DataFrame:
    repeated = projection.seasonal(panel_brand(spark, folder), horizon=18, entity="entity_id")
    return _rounded(repeated, 4, "projected_drift")


@_query
def projection_backtest(spark: SparkSession, folder: str) -> DataFrame:
    tested = projection.backtest(panel_brand(spark, folder), entity="entity_id", horizon=3, least=24)
    return _rounded(tested, 4, "mae", "rmse", "mape", "bias")


def _part_volumes(spark: SparkSession, folder: str) -> DataFrame:
    # A part has few lines in a month, so there are nearly as many cells as lines.
    tasks = reshape.cell_tasks(table(spark, folder, "lineitem"))
    return pricevolume.match_volumes(unit_price_part(spark, folder, tasks), volume_part(spark, folder, tasks))


@_query
def price_volume(spark: SparkSession, folder: str) -> DataFrame:
    index = pricevolume.weighted_index(_part_volumes(spark, folder), list_price_part(spark, folder))
    return _rounded(_rounded(index, 2, "turnover"), 6, "unit_value", "index_100", "matched_pct")


@_query
def price_volume_own_base(spark: SparkSession, folder: str) -> DataFrame:
    index = pricevolume.weighted_index(_part_volumes(spark, folder))
    return _rounded(_rounded(index, 2, "turnover"), 6, "unit_value", "index_100", "matched_pct")


@_query
def price_volume_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(pricevolume.unmatched(_part_volumes(spark, folder)), 6, "volume_pct")


# --- Quality --------------------------------------------------------------------------


@_query
def quality_completeness(spark: SparkSession, folder: str) -> DataFrame:
    wide = wide_priority(spark, folder)
    columns = [name for name in wide.columns if name != "date"]
    return _rounded(quality.completeness(wide, columns), 4, "missing_pct")


@_query
def quality_nulls_stage(spark: SparkSession, folder: str) -> DataFrame:
    profile = _order_profile(spark, folder)
    return quality.missing_by_stage(profile, date="raw_date", measures=["raw_price"])


@_query
def quality_consistency(spark: SparkSession, folder: str) -> DataFrame:
    profile = _order_profile(spark, folder)
    return quality.consistency(profile, date="raw_date", measures=["raw_price"])


@_query
def quality_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    # The output is counted as it was written, not as the deduplication promises it.
    path = scratch_path(spark, "first-lines")
    dedup_keep_first(spark, folder).write.parquet(path)
    stages = {"input": table(spark, folder, "lineitem"), "output": spark.read.parquet(path)}
    return _done(quality.uniqueness(stages, ["l_orderkey", "l_linenumber"]), path)


@_query
def quality_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    suppliers = table(spark, folder, "supplier")
    stages = [
        quality.accuracy(customers, ["c_acctbal"], "input"),
        quality.accuracy(cleaning.non_negative(customers, ["c_acctbal"]), ["c_acctbal"], "output"),
        quality.accuracy(suppliers, ["s_acctbal"], "input"),
        quality.accuracy(cleaning.non_negative(suppliers, ["s_acctbal"]), ["s_acctbal"], "output"),
    ]
    return reduce(DataFrame.unionByName, stages)


@_query
def quality_coverage(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return quality.coverage(lines)


@_query
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    # Two branches use different columns of the profile, which has one row per date: it is
    # kept, so that the raw rows behind it are read once.
    shared_folder(spark)
    profile = _order_profile(spark, folder).checkpoint()
    kept = cleaning.survivors(profile, date="raw_date", measures=["raw_price"]).checkpoint()
    long = reshape.unpivot_long(kept, ids=["raw_date"], measures={"raw_price": "price"})
    flagged = change.outliers(long, date="raw_date")
    report = quality.quality_report(
        profile, flagged, date="raw_date", measures=["raw_price"], output=kept
    )
    return _rounded(report, 4, "value")


# --- Raw file to answers --------------------------------------------------------------


@_query
def silver_table(spark: SparkSession, folder: str) -> DataFrame:
    return _shipments(spark, folder).silver


@_query
def gold_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return _shipments(spark, folder).monthly


@_query
def gold_annual(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_shipments(spark, folder).annual, 4, "mean_value", "sd_value")


@_query
def gold_change(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_shipments(spark, folder).change, 6, "change_pct")


@_query
def answer_evolution(spark: SparkSession, folder: str) -> DataFrame:
    return answers.evolution(_shipments(spark, folder))


@_query
def answer_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(answers.correlation(_shipments(spark, folder)), 6, "corr")


@_query
def answer_volatility(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(answers.volatility_ranking(_shipments(spark, folder)), 4, "volatility")


@_query
def answer_volatility_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(answers.volatility_by_year(_shipments(spark, folder)), 4, "volatility")


@_query
def answer_volatility_peak(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(answers.volatility_peak(_shipments(spark, folder)), 4, "peak_volatility")


@_query
def answer_correlation_wide(spark: SparkSession, folder: str) -> DataFrame:
    return answers.correlation_wide(_shipments(spark, folder), digits=6)


@_query
def answer_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(answers.outlying_moves(_shipments(spark, folder)), 6, "change_pct")


@_query
def answer_extremes(spark: SparkSession, folder: str) -> DataFrame:
    return answers.extreme_moves(_shipments(spark, folder), k=10, digits=4)


@_query
def answer_rebased(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(answers.rebased(_shipments(spark, folder)), 6, "index_100")


@_query
def answer_projection(spark: SparkSession, folder: str) -> DataFrame:
    ahead = answers.projection(_shipments(spark, folder), horizon=5, grain="day")
    return _rounded(ahead, 4, "slope", "residual_sd", "projected", "low", "high")


@_query
def load_funnel(spark: SparkSession, folder: str) -> DataFrame:
    bronze = medallion.bronze(raw_shipments(spark, folder), "lineitem")
    profile = medallion.load_profile(bronze, SHIPMENTS, shipment_order())
    return cleaning.cleaning_funnel(profile, date=SHIPMENTS.date, measures=SHIPMENTS.measures)


@_query
def load_silver(spark: SparkSession, folder: str) -> DataFrame:
    bronze = medallion.bronze(raw_shipments(spark, folder), "lineitem")
    profile = medallion.load_profile(bronze, SHIPMENTS, shipment_order())
    return medallion.silver_of(profile, SHIPMENTS)


@_query
def analysis_document(spark: SparkSession, folder: str) -> DataFrame:
    document = reports.analysis_document(reports.analysis_report(_shipments(spark, folder)), SHIPMENTS)
    return _plain(document.select("correlation:Extended price~Quantity", *_numbers(document)))


def _plain(document: DataFrame) -> DataFrame:
    """Field names as column names that any engine takes."""
    return document.toDF(*[re.sub(r"\W+", "_", name) for name in document.columns])


def _numbers(document: DataFrame) -> list:
    """The document's nested fields as columns that any engine can compare."""
    lay = SHIPMENTS
    moves = [
        (F.round(value, 4) if name == lay.change else value).alias(f"{side}:{place + 1}:{name}")
        for side in ("rises", "falls")
        for place in range(5)
        for name in (lay.date, lay.name, lay.change)
        for value in [F.get(F.col(side), F.lit(place))[name]]
    ]
    names = [f"{what}:{name}" for what in ("benchmark", "growth") for name in SHIPMENTS.focus]
    swings = [
        F.col("volatility")[name].alias(f"volatility:{name}") for name in ("Quantity", "Extended price", "Tax")
    ]
    return [*moves, *swings, *[F.col(name) for name in names]]


@_query
def quality_document(spark: SparkSession, folder: str) -> DataFrame:
    bronze = medallion.bronze(raw_shipments(spark, folder), "lineitem")
    shared_folder(spark)
    profile = medallion.load_profile(bronze, SHIPMENTS, shipment_order()).checkpoint()
    star = medallion.Star.derive(spark, medallion.silver_of(profile, SHIPMENTS), SHIPMENTS)
    document = reports.quality_document(reports.quality_of_load(profile, star), SHIPMENTS)
    flat = [
        F.col(part)[name].alias(f"{part}:{name}")
        for part in ("missing_in", "missing_out", "negative", "coverage")
        for name in document.schema[part].dataType.names
    ]
    return _plain(document.select(*flat, "surplus", "undated", "rows_in", "rows_out"))


@_query
def analysis_report(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(reports.analysis_report(_shipments(spark, folder)), 4, "value")


# --- Tables written by jobs -----------------------------------------------------------


@_query
def csv_text(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(raw_shipments(spark, folder), path)
    return _done(ingest.rename_to_technical(read_csv(spark, path)), path)


def _done(result: DataFrame, path: str, schema: str | None = None) -> DataFrame:
    """The result by itself, without the scratch files and tables that it was read from."""
    spark = result.sparkSession
    kept = result.checkpoint()
    if schema:
        spark.sql(f"DROP SCHEMA {schema} CASCADE")
    discard(spark, path)
    return kept


@_query
def csv_multiline(spark: SparkSession, folder: str) -> DataFrame:
    # One file, of which every task reads a piece; values hold line breaks, quotes and nothing.
    path = scratch_path(spark, "multiline")
    kind, priority = F.col("o_orderkey") % 6, F.col("o_orderpriority")
    note = (
        F.when(kind == 0, F.concat(priority, F.lit('\nsecond "line", '), F.col("o_orderstatus")))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit(None).cast("string"))
        .when(kind == 3, F.lit("\n\n"))
        .when(kind == 4, F.concat(priority, F.lit(", x")))
        .otherwise(priority)
    )
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"), note.alias("a note"))
    write_csv(orders, path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        read = read_csv(spark, path, across_lines=True).drop(FILE, BLOCK, ROW_ID)
        return _done(ingest.rename_to_technical(read), path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@_query
def csv_malformed(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "malformed")
    key = F.col("o_orderkey")
    cells = [key, F.rint(F.col("o_totalprice") * 100).cast("long"), F.lit("EXTRA")]
    n = F.when(key % 7 == 0, 3).when(key % 11 == 0, 1).otherwise(2)
    text = F.array_join(F.slice(F.array(*[c.cast("string") for c in cells]), F.lit(1), n), ",")
    lines = table(spark, folder, "orders").select(text.alias("key,cents"))
    lines.write.options(header=True, sep="|", quote="").csv(path)
    return _done(read_csv(spark, path), path)


@_query
def json_report(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json")
    report = analysis_report(spark, folder)
    write_json(report, path)
    return _done(spark.read.schema(report.schema).json(path), path)


@_query
def job_change(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "job")
    write_csv(raw_shipments(spark, folder), f"{path}/raw")
    star = medallion.run(
        spark,
        f"{path}/raw",
        schema=f"shipments_{path[-12:]}",
        layout=SHIPMENTS,
        location=f"{path}/tables",
        partition_facts=True,
        order_by=shipment_order(),
    )
    return _rounded(_done(star.change, path, f"shipments_{path[-12:]}"), 6, "change_pct")


@_query
def load_files_first(spark: SparkSession, folder: str) -> DataFrame:
    # Two folders of unequal size that share most dates; in each, files and their rows are
    # in the order of the keys, which is then the order of the load.
    path = scratch_path(spark, "files")
    raw = raw_shipments(spark, folder)
    keys = [F.col(name).cast("bigint") for name in ("Order Key", "Line Number", "Part Key", "Supplier Key")]
    ordered = [*keys, "Quantity", "Extended Price, USD", "Tax %"]
    first = F.col("Line Number") == "1"
    # Sorted by more tasks than the session's shuffle partitions where each would hold too much.
    tasks = reshape.cell_tasks(table(spark, folder, "lineitem"))
    for part, rows in enumerate([raw.where(first), raw.where(~first)]):
        dealt = rows.orderBy(*ordered) if tasks is None else rows.repartitionByRange(tasks, *ordered).sortWithinPartitions(*ordered)
        write_csv(dealt, f"{path}/raw/{part}")
    star = medallion.run(
        spark,
        f"{path}/raw/*",
        schema=f"files_{path[-12:]}",
        layout=SHIPMENTS,
        location=f"{path}/tables",
    )
    return _done(star.silver, path, f"files_{path[-12:]}")


@_query
def refresh_change(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "refresh")
    raw = raw_shipments(spark, folder)
    early = F.coalesce(F.col(raw.columns[0]) < "1998-01-01", F.lit(False))
    refresh = Refresh(SHIPMENTS, f"{path}/tables", shipment_order())
    for part, rows in enumerate([raw.where(early), raw.where(~early)]):
        write_csv(rows, f"{path}/raw/part={part}")
        refresh.stream(spark, f"{path}/raw/*", raw.columns).awaitTermination()
    return _rounded(_done(refresh.read(spark, "change"), path), 6, "change_pct")


def _three_loads(spark: SparkSession, folder: str, path: str) -> Refresh:
    """All shipments in three loads that share most dates, merged while they arrive."""
    bronze = medallion.bronze(raw_shipments(spark, folder), "lineitem")
    turn = F.least(F.floor((F.col("Line_Number").cast("int") - 1) / 2), F.lit(2))
    refresh = Refresh(SHIPMENTS, path, shipment_order(), fan_in=2)
    for number in range(3):
        refresh.apply(bronze.where(turn == number), number)
        refresh.compact(spark)
    return refresh


@_query
def refresh_quality(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "refresh")
    report = _three_loads(spark, folder, path).quality(spark)
    return _rounded(_done(report, path), 4, "value")


@_query
def refresh_correlation(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "refresh")
    refresh = _three_loads(spark, folder, path)
    benchmark = refresh.benchmark_correlation(spark).withColumn("entity_b", F.lit(-1))
    pairs = benchmark.select(F.col("entity_id").alias("entity_a"), "entity_b", "corr", "n")
    return _rounded(_done(refresh.correlation(spark).unionByName(pairs), path), 9, "corr")


@_query
def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    # Three arrivals out of order; each starts the stream anew from its checkpoint.
    path = scratch_path(spark, "events")
    events = table(spark, folder, "events")
    day, straggler = F.dayofmonth("ts"), F.col("event_id") % 50 == 0
    turn = F.when(straggler, 2).when(day.between(11, 20), 0).when(day <= 10, 1).otherwise(2)
    windows = EventWindows(f"{path}/kept", salts=4)
    for number in range(3):
        events.where(turn == number).write.mode("append").parquet(f"{path}/arriving")
        windows.stream(spark, f"{path}/arriving", events.schema).awaitTermination()
    return _done(windows.read(spark), path)
