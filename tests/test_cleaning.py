import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cleaning, conform, ingest, quality
from tidemark.plans import medallion
from tidemark.plans.layout import Layout
from tidemark.sources.readers import CORRUPT, read_csv

from helpers import day, rows


def raw(spark, data):
    return spark.createDataFrame(data, "seq long, d string, a string, b string")


DATA = [
    (1, "2020-01-01", "1", "5"),
    (2, "2020-01-01", "2", "6"),
    (3, "bad", "3", "7"),
    (4, None, "4", "8"),
    (5, "2020-01-02", "-1", "9"),
    (6, "2020-01-02", "1", "9"),
    (7, "2020-01-03", "x", "NaN"),
    (8, "2020-13-01", "1", "1"),
    (9, "", "1", "1"),
    (10, "2020-01-04", None, "1e3"),
]


def silver(spark, data):
    typed = conform.typed(raw(spark, data), dates=["d"], numbers=["a", "b"])
    return cleaning.clean(typed, key="d", measures=["a", "b"], order_by=["seq"])


def test_rules_apply_in_order(spark):
    assert rows(silver(spark, DATA), "seq", "d", "a", "b") == [
        (1, day("2020-01-01"), 1.0, 5.0),
        (7, day("2020-01-03"), None, None),
        (10, day("2020-01-04"), None, 1000.0),
    ]


def test_date_disappears_when_its_first_row_is_negative(spark):
    kept = {row.d for row in silver(spark, DATA).collect()}
    assert day("2020-01-02") not in kept


def test_cleaning_twice_changes_nothing(spark):
    once = silver(spark, DATA)
    twice = cleaning.clean(once, key="d", measures=["a", "b"], order_by=["seq"])
    assert rows(once) == rows(twice)


def test_profile_agrees_with_the_rules(spark):
    profile = cleaning.cleaning_profile(
        raw(spark, DATA), date="d", measures=["a", "b"], order_by="seq"
    )
    survivors = cleaning.survivors(profile, date="d", measures=["a", "b"])
    assert rows(survivors) == rows(silver(spark, DATA), "d", "a", "b")


def test_profile_accepts_a_compound_order(spark):
    order = F.struct(F.col("b"), F.col("seq"))
    profile = cleaning.cleaning_profile(
        raw(spark, DATA), date="d", measures=["a"], order_by=order
    )
    typed = conform.typed(raw(spark, DATA), dates=["d"], numbers=["a"])
    kept = cleaning.clean(typed, key="d", measures=["a"], order_by=["b", "seq"])
    assert rows(cleaning.survivors(profile, date="d", measures=["a"])) == rows(kept, "d", "a")


def test_profile_by_splits_sorts_no_rows(spark):
    split = F.struct(F.when(F.col("seq") % 3 == 0, "x").otherwise("y").alias("file"), (F.col("seq") % 2).alias("block"))
    given = {"date": "d", "measures": ["a", "b"]}
    wanted = cleaning.cleaning_profile(raw(spark, DATA), **given, order_by=F.struct(split, "seq"))
    found = cleaning.cleaning_profile(raw(spark, DATA), **given, order_by="seq", within=split)
    assert found.columns == wanted.columns and rows(found) == rows(wanted)
    with pytest.raises(ValueError):
        cleaning.cleaning_profile(raw(spark, DATA), **given, order_by="b", within=split)


def test_loads_in_file_order_sort_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,Copper\n2020-01-01,1\n2020-01-01,2\nx,3\n")
    (tmp_path / "b.csv").write_text("Date,Copper\n2020-01-01,4\n2020-01-02,-5\n,6\n")
    layout = Layout(mapping={"Date": "day", "Copper": "copper"}, date="day", benchmark="copper", entities=(), tables={})
    raw_rows = medallion.bronze(read_csv(spark, str(tmp_path)))
    profile = medallion.load_profile(ingest.number_rows(ingest.locate(raw_rows)), layout)
    plan = profile._jdf.queryExecution().executedPlan().toString()
    beside_the_scan = plan[plan.rindex("Exchange") :]
    assert "HashAggregate" in beside_the_scan and "Sort" not in beside_the_scan
    assert rows(profile, "day", "n_rows", "copper") == [(day("2020-01-01"), 3, 1.0), (day("2020-01-02"), 1, -5.0), (None, 2, 3.0)]


@pytest.mark.parametrize("order", ["seq", "b"])
def test_rows_without_an_order_come_first(spark, order):
    data = [(1, "2020-01-01", "1", "x"), (None, "2020-01-01", "2", None),
            (None, "2020-01-02", "3", None)]
    profile = cleaning.cleaning_profile(
        raw(spark, data), date="d", measures=["a"], order_by=order
    )
    assert rows(cleaning.survivors(profile, date="d", measures=["a"])) == [
        (day("2020-01-01"), 2.0), (day("2020-01-02"), 3.0)
    ]


def test_funnel_attributes_each_row_once(spark):
    profile = cleaning.cleaning_profile(
        raw(spark, DATA), date="d", measures=["a", "b"], order_by="seq"
    )
    funnel = cleaning.cleaning_funnel(profile, date="d", measures=["a", "b"])
    assert rows(funnel) == [
        (1, "valid_date", 10, 4, 6),
        (2, "first_per_date", 6, 2, 4),
        (3, "non_negative", 4, 1, 3),
    ]


def test_funnel_of_an_empty_input(spark):
    profile = cleaning.cleaning_profile(raw(spark, []), date="d", measures=["a"], order_by="seq")
    funnel = cleaning.cleaning_funnel(profile, date="d", measures=["a"])
    assert [row[2:] for row in rows(funnel)] == [(0, 0, 0)] * 3


@pytest.mark.parametrize("few_keys", [False, True])
def test_keep_first_against_brute_force(spark, few_keys):
    rng = random.Random(7)
    data = [(i, rng.choice("aaaabc"), rng.randrange(50)) for i in range(400)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "seq long, k string, v int").repartition(5)
    best = {}
    for seq, key, value in data:
        if key not in best or (value, seq) < best[key][:2]:
            best[key] = (value, seq)
    kept = cleaning.keep_first(df, ["k"], ["v", "seq"], few_keys=few_keys)
    assert kept.columns == df.columns
    assert rows(kept, "k", "v", "seq") == sorted((k, v, s) for k, (v, s) in best.items())


@pytest.mark.parametrize("few_keys", [False, True])
def test_null_keys_are_one_group(spark, few_keys):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", None), ("a", 3)], "k string, v int")
    kept = cleaning.keep_first(df, ["k"], ["v"], few_keys=few_keys)
    assert rows(kept) == [("a", None), (None, 1)]


@pytest.mark.parametrize("split", ["700", "2000", "128m"])
@pytest.mark.parametrize("parallelism", ["1", "4", "16"])
def test_recorded_order_follows_the_files(spark, tmp_path, split, parallelism):
    # The larger file comes second by path, and is what Spark packs first.
    for name, numbers in (("a", range(500)), ("b", range(500, 2000))):
        lines = "".join(f"2020-01-01,{i}\n" for i in numbers)
        (tmp_path / f"{name}.csv").write_text("d,a\n" + lines)
    settings = {
        "spark.sql.files.maxPartitionBytes": split,
        "spark.sql.files.minPartitionNum": parallelism,
        "spark.sql.files.openCostInBytes": "0",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        scan = spark.read.option("header", True).csv(str(tmp_path))
        df = ingest.number_rows(ingest.locate(scan)).withColumn("at", ingest.source_order())
        for few_keys in (False, True):
            assert rows(cleaning.keep_first(df, ["d"], ["at"], few_keys=few_keys), "a") == [("0",)]
        in_order = [row.a for row in df.orderBy("at").collect()]
        assert in_order == [str(i) for i in range(2000)]
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_malformed_lines_are_kept_and_counted(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("d,v\n2020-01-01,1\n2020-02-01,2,EXTRA\n2020-03-01\n")
    df = read_csv(spark, str(path))
    assert rows(df) == [
        ("2020-01-01", "1", None), ("2020-02-01", "2", "2020-02-01,2,EXTRA"),
        ("2020-03-01", None, "2020-03-01"),
    ]
    profile = cleaning.cleaning_profile(df, date="d", measures=["v"], order_by="d", corrupt=CORRUPT)
    funnel = rows(cleaning.cleaning_funnel(profile, date="d", measures=["v"]))
    assert funnel[:2] == [(0, "malformed_kept", 2, 0, 2), (1, "valid_date", 3, 0, 3)]
    flagged = spark.createDataFrame([], "x int")
    report = quality.quality_report(profile, flagged, date="d", measures=["v"])
    assert [r.value for r in report.where("metric = 'malformed_rows'").collect()] == [2.0]


def test_conform_reports_all_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "`a b` int")
    assert conform.conform(df, {"a_b": "x"}).columns == ["x"]
    with pytest.raises(ValueError, match="p.*q"):
        conform.conform(df, {"p": "x", "a b": "y", "q": "z"})


def test_typing_reads_what_is_already_typed(spark):
    df = spark.createDataFrame([("2020-01-05", 2.5)], "d string, v double").withColumn(
        "d", F.to_date("d")
    )
    assert rows(conform.typed(df, dates=["d"], numbers=["v"])) == [(day("2020-01-05"), 2.5)]


def test_stamp_uses_the_file_path_without_a_source(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a\n1\n")
    df = ingest.stamp(spark.read.option("header", True).csv(str(path)))
    (row,) = df.collect()
    assert row._source.endswith("in.csv") and row._ingestion_timestamp is not None
    assert row.a == "1"


def test_union_by_name_ignores_column_order(spark):
    left = spark.createDataFrame([(1, "a")], "x int, y string")
    right = spark.createDataFrame([("b", 2)], "y string, x int")
    assert rows(conform.union_sources(left, right)) == [(1, "a"), (2, "b")]


def test_shape_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    assert rows(ingest.shape_profile(df)) == [(2, 2, "struct<x:int,y:string>")]
