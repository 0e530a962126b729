"""What Spark does with each query: scans, shuffles, joins, and where code runs."""

import contextlib
import io
import re

import pytest

from tidemark.operators import change, relation
from tidemark.plans.registry import QUERIES

from helpers import day

FOLDER = "/root/testdata/sf0.001"

# Queries whose inputs are several tables, stages or roles of one table, with their scans.
SCANS = {
    "correlation_matrix_brand": 2,
    "outliers_3sigma": 2,
    "price_volume": 3,
    "price_volume_own_base": 2,
    "price_volume_unmatched": 2,
    "projection_backtest": 2,
    "projection_seasonal": 2,
    "projection_trend": 2,
    "quality_accuracy": 4,
    "top_moves": 2,
    "top_moves_per_entity": 2,
    "union_sources": 2,
}

# Queries that read what an earlier job of theirs has stored.
CUT = (
    "csv_malformed csv_multiline csv_text dim_entity event_windows job_change json_report "
    "load_files_first quality_document quality_report quality_uniqueness refresh_change "
    "refresh_correlation refresh_quality"
).split()


def executed(df):
    """The plan after the run, with what adaptive execution made of it."""
    df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    plan = text.getvalue().split("== Initial Plan ==")[0]
    return plan.splitlines()


@pytest.fixture(scope="module")
def plans(spark):
    done = {}

    def get(name):
        if name not in done:
            done[name] = executed(QUERIES[name](spark, FOLDER))
        return done[name]

    return get


def lines(plan, pattern):
    return [line for line in plan if re.search(pattern, line)]


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_join_and_no_python_in_the_plan(plans, name):
    assert not lines(plans(name), r"Cartesian|NestedLoop|Python|Pandas|ArrowEval|MapIn")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in CUT])
def test_each_input_is_scanned_once(plans, name):
    assert len(lines(plans(name), "FileScan")) == SCANS.get(name, 1)


@pytest.mark.parametrize("name", QUERIES)
def test_only_totals_meet_in_one_task(plans, name):
    """An unpartitioned shuffle takes one partial total per task, or one row per range."""
    plan = plans(name)
    for i, line in enumerate(plan):
        if "SinglePartition" in line:
            below = plan[i + 1]
            totals = re.search(r"HashAggregate\(keys=\[\], functions=\[partial", below)
            ranges = name == "dim_entity" and "_range" in "".join(plan[i : i + 3])
            assert totals or ranges, below


@pytest.mark.parametrize("name", QUERIES)
def test_groups_are_combined_before_they_are_shuffled(plans, name):
    plan = plans(name)
    for i, line in enumerate(plan):
        final = re.search(r"Aggregate\(keys=\[.+\], functions=\[(?!partial)\w+\(", line)
        if final and "Exchange hashpartitioning" in "".join(plan[i + 1 : i + 4]):
            assert lines(plan[i + 1 : i + 7], "functions=.partial|ReusedExchange"), line


def test_panel_reads_three_columns(plans):
    (scan,) = lines(plans("mom_change"), "FileScan")
    assert "[o_totalprice" in scan and "o_orderdate" in scan and "o_orderpriority" in scan
    assert "o_custkey" not in scan and "o_orderkey" not in scan


def test_choice_of_entities_reaches_the_scan(plans):
    (scan,) = lines(plans("volatility_by_year"), "FileScan")
    assert "In(o_orderpriority, [1-URGENT,2-HIGH])" in scan


def test_outliers_share_the_shuffle_of_the_change(spark, panel):
    data = [(f"2020-{m:02d}-01", e, float(m)) for m in range(1, 13) for e in "ab"]
    plan = executed(change.outliers(panel(data)))
    assert len(lines(plan, r"- Exchange")) == 1 and not lines(plan, "Join")


def test_dedup_is_limited_before_the_shuffle(plans):
    plan = plans("dedup_keep_first")
    assert lines(plan, r"WindowGroupLimit.*Partial") and lines(plan, r"WindowGroupLimit.*Final")


@pytest.mark.parametrize("name", ["top_moves", "top_moves_per_entity", "answer_extremes"])
def test_extremes_are_limited_before_the_shuffle_and_lag_once(plans, name):
    plan = plans(name)
    if name == "top_moves_per_entity":  # ranked where the change has dealt the entities: no shuffle
        panel, by_entity = lines(plan, r"- Exchange hashpartitioning")[::-1]
        assert re.search(r"hashpartitioning\(entity_id#\d+, ", by_entity) and "date" in panel
        assert lines(plan, r"WindowGroupLimit")
    else:
        assert lines(plan, r"WindowGroupLimit.*Partial")
    assert len(lines(plan, r"Window \[lag")) == 1


def test_series_of_a_date_are_dealt_over_salts(plans):
    joins = lines(plans("correlation_matrix_brand"), "Join.*_salt")
    assert joins and all("date" in join for join in joins if "_block" in join)


def test_panel_is_not_shuffled_to_meet_its_benchmark(plans):
    plan = plans("benchmark_align")
    assert lines(plan, "BroadcastHashJoin.*LeftOuter, BuildRight")
    assert len(lines(plan, r"- Exchange")) == 2  # the panel's groups, the benchmark's dates


def test_literal_dimension_is_broadcast_by_its_known_size(plans):
    plan = plans("join_dim")
    assert lines(plan, "BroadcastHashJoin") and lines(plan, "LocalTableScan")
    assert not lines(plan, "SortMergeJoin")


def test_profile_is_a_hash_aggregate(plans):
    assert not lines(plans("clean_funnel"), "SortAggregate")


def test_plan_of_the_matrix_does_not_grow_with_the_entities(spark, panel):
    sizes = []
    for n in (2, 40):
        data = [(f"2020-{m:02d}-01", e, float(m * e % 7)) for m in range(1, 13) for e in range(n)]
        plan = executed(relation.correlation_matrix(panel(data, "int"), entity="entity"))
        sizes.append(len(plan))
    assert sizes[0] == sizes[1]


def test_one_entity_with_most_rows_is_one_row_per_period_and_task(spark):
    """A third of a million raw rows of one entity reach the shuffle as a handful."""
    from pyspark.sql import functions as F

    from tidemark.operators.reshape import to_panel

    other = F.concat(F.lit("e"), F.col("id") % 50)
    hot = spark.range(300_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(other).alias("e"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") % 300).cast("int")).alias("d"),
        (F.col("id") % 101).cast("double").alias("v"),
    )
    panel = to_panel(hot, date=F.col("d"), entity=F.col("e"), value=F.col("v"), decimals=0)
    assert lines(executed(panel), "partial_sum")
    row = panel.where("entity = 'hot'").orderBy("date").first()
    january = [i % 101 for i in range(0, 300_000, 3) if i % 300 < 31]
    assert (row.date, row.value) == (day("2020-01-01"), sum(january) / len(january))
