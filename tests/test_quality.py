import math

from pyspark.sql import functions as F

from tidemark.operators import cleaning, quality

from helpers import day, rows


def test_completeness_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, None), (None, "b"), (2.0, "c")],
                               "v double, t string")
    assert rows(quality.completeness(df, ["v", "t"])) == [("t", 4, 1, 25.0), ("v", 4, 2, 50.0)]


def test_completeness_of_an_empty_table(spark):
    df = spark.createDataFrame([], "v double")
    assert rows(quality.completeness(df, ["v"])) == [("v", 0, 0, None)]


def test_uniqueness_counts_null_keys_as_one(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), (None,), (None,), ("b",)], "k string")
    stages = {"input": df, "output": df.distinct(), "broken": df.where("k = 'a'")}
    found = rows(quality.uniqueness(stages, ["k"]))
    assert found == [("broken", 2, 1, 1), ("input", 6, 2, 3), ("output", 3, 0, 0)]
    assert rows(quality.uniqueness(df.limit(0), ["k"])) == [
        ("input", 0, 0, 0), ("output", 0, 0, 0)
    ]


def test_accuracy_is_zero_not_null_on_empty_input(spark):
    df = spark.createDataFrame([(-1.0, 1.0), (None, -2.0), (-3.0, 0.0)], "a double, b double")
    assert rows(quality.accuracy(df, ["a", "b"])) == [("input", "a", 2), ("input", "b", 1)]
    assert rows(quality.accuracy(df.limit(0), ["a"])) == [("input", "a", 0)]


RAW = [(1, "2020-01-01", "1"), (2, "2020-01-01", "-2"), (3, "bad", "x"), (4, None, None),
       (5, "2020-02-01", "-5"), (6, "2020-03-01", "NaN")]


def raw(spark, data=RAW):
    return spark.createDataFrame(data, "seq long, d string, v string")


def profile(spark, data=RAW):
    return cleaning.cleaning_profile(raw(spark, data), date="d", measures=["v"], order_by="seq")


def test_stages_tell_absent_from_unreadable(spark):
    found = rows(quality.missing_by_stage(profile(spark), date="d", measures=["v"]))
    assert found == [("input", "d", 1, 1), ("input", "v", 1, 2), ("output", "d", 0, 0),
                     ("output", "v", 1, 0)]


def test_consistency(spark):
    (row,) = quality.consistency(profile(spark), date="d", measures=["v"]).collect()
    assert (row.rows_in, row.rows_out, row.rows_discarded) == (6, 2, 4)
    assert (row.absent_dates, row.unreadable_dates) == (1, 1)


def test_coverage(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2021-05-01",), (None,)], "d string").select(
        F.to_date("d").alias("date")
    )
    assert rows(quality.coverage(df)) == [(day("2020-01-01"), day("2021-05-01"))]


def test_report_puts_all_dimensions_together(spark):
    outliers = spark.createDataFrame([(1,), (2,)], "x int")
    report = quality.quality_report(profile(spark), outliers, date="d", measures=["v"])
    found = {tuple(r[:4]): (r.value, r.day) for r in report.collect()}
    assert {key[0] for key in found} == {
        "completeness", "consistency", "uniqueness", "accuracy", "outliers", "coverage"
    }
    assert found["completeness", "input", "v", "unparseable"] == (2.0, None)
    assert found["completeness", "output", "v", "missing_pct"] == (50.0, None)
    assert found["consistency", "output", None, "rows_discarded"] == (4.0, None)
    assert found["uniqueness", "input", "d", "surplus_rows"] == (2.0, None)
    assert found["accuracy", "input", "v", "negative"] == (2.0, None)
    assert found["accuracy", "output", "v", "negative"] == (0.0, None)
    assert found["outliers", "output", None, "beyond_sigmas"] == (2.0, None)
    assert found["coverage", "output", "d", "last"] == (None, day("2020-03-01"))


def test_report_of_an_empty_input(spark):
    outliers = spark.createDataFrame([], "x int")
    report = quality.quality_report(profile(spark, []), outliers, date="d", measures=["v"])
    found = {tuple(r[:4]): r.value for r in report.collect()}
    assert found["consistency", "input", None, "rows"] == 0.0
    assert found["completeness", "output", "v", "missing_pct"] is None
