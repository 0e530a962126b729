"""Prices beside volumes: no cell of either side is lost."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import pricevolume, reshape

from helpers import day, rows


@pytest.fixture
def cells(spark):
    def make(data, name):
        df = spark.createDataFrame(data, f"d string, entity string, {name} double")
        return df.select(F.to_date("d").alias("date"), "entity", name)

    return make


PRICES = [("2020-01-01", "a", 2.0), ("2020-02-01", "a", 3.0), ("2020-01-01", "b", 5.0), (None, "a", 7.0), ("2020-01-01", "z", None)]
VOLUMES = [("2020-01-01", "a", 10.0), ("2020-02-01", "a", 20.0), ("2020-02-01", "b", 4.0), (None, "a", 1.0), ("2020-03-01", "c", 0.0)]


def test_both_sides_keep_their_cells(cells):
    found = pricevolume.match_volumes(cells(PRICES, "price"), cells(VOLUMES, "volume"))
    assert found.columns == ["date", "entity", "price", "volume", "side"]
    assert rows(found) == rows_of([
        (day("2020-01-01"), "a", 2.0, 10.0, "both"),
        (day("2020-01-01"), "b", 5.0, None, "price_only"),
        (day("2020-02-01"), "a", 3.0, 20.0, "both"),
        (day("2020-02-01"), "b", None, 4.0, "volume_only"),
        (day("2020-03-01"), "c", None, 0.0, "volume_only"),
        (None, "a", 7.0, None, "price_only"),
        (None, "a", None, 1.0, "volume_only"),
    ])


def rows_of(data):
    return sorted(data, key=lambda row: [(value is None, value) for value in row])


def test_equal_to_a_full_outer_join(cells, spark):
    rng = random.Random(3)
    keys = [(f"2020-{m:02d}-01", f"e{i}") for m in range(1, 13) for i in range(20)]
    prices = cells([(*k, round(rng.uniform(1, 9), 2)) for k in keys if rng.random() < 0.6], "price")
    volumes = cells([(*k, float(rng.randrange(50))) for k in keys if rng.random() < 0.6], "volume")
    joined = prices.join(volumes, ["date", "entity"], "full_outer")
    found = pricevolume.match_volumes(prices, volumes)
    assert rows(found.drop("side")) == rows(joined.select("date", "entity", "price", "volume"))


def test_repeated_cells_are_combined_and_names_kept(cells):
    prices = cells([("2020-01-01", "a", 2.0), ("2020-01-01", "a", 4.0)], "price").toDF("day", "part", "p")
    volumes = cells([("2020-01-01", "a", 1.0), ("2020-01-01", "a", 2.0)], "volume").toDF("day", "part", "v")
    found = pricevolume.match_volumes(prices, volumes, date="day", entity="part", price="p", volume="v")
    assert found.columns == ["day", "part", "p", "v", "side"] and rows(found) == [(day("2020-01-01"), "a", 3.0, 3.0, "both")]


def test_unmatched_sides_are_reported(cells):
    matched = pricevolume.match_volumes(cells(PRICES, "price"), cells(VOLUMES, "volume"))
    assert rows(pricevolume.unmatched(matched)) == rows_of([
        (day("2020-01-01"), "price_only", 1, None, None),
        (day("2020-02-01"), "volume_only", 1, 4.0, 4 / 24 * 100),
        (day("2020-03-01"), "volume_only", 1, 0.0, None),
        (None, "price_only", 1, None, None),
        (None, "volume_only", 1, 1.0, 100.0),
    ])


def test_index_weighs_prices_by_volume(cells, spark):
    prices = cells([("2020-01-01", "a", 2.0), ("2020-01-01", "b", 10.0), ("2020-02-01", "a", 3.0), ("2020-02-01", "b", 5.0)], "price")
    volumes = cells([("2020-01-01", "a", 1.0), ("2020-01-01", "b", 1.0), ("2020-02-01", "a", 4.0), ("2020-02-01", "b", 2.0), ("2020-02-01", "c", 2.0)], "volume")
    matched = pricevolume.match_volumes(prices, volumes)
    first, second = pricevolume.weighted_index(matched).orderBy("date").collect()
    assert (first.n_entities, first.turnover, first.unit_value, first.index_100, first.matched_pct) == (2, 12.0, 6.0, 100.0, 100.0)
    assert (second.turnover, second.volume, second.matched_pct) == (22.0, 6.0, 75.0)
    assert second.index_100 == pytest.approx((3 * 4 + 5 * 2) / (2 * 4 + 10 * 2) * 100)
    base = spark.createDataFrame([("a", 4.0), ("c", 1.0)], "entity string, base double")
    first, second = pricevolume.weighted_index(matched, base).orderBy("date").collect()
    assert (first.index_100, second.index_100) == (50.0, 75.0)  # b has no base price
    assert first.turnover == 12.0


def test_empty_sides(cells):
    none = pricevolume.match_volumes(cells([], "price"), cells([], "volume"))
    assert rows(none) == rows(pricevolume.unmatched(none)) == rows(pricevolume.weighted_index(none)) == []
    prices = pricevolume.match_volumes(cells(PRICES[:1], "price"), cells([], "volume"))
    (row,) = pricevolume.weighted_index(prices).collect()
    assert (row.n_entities, row.volume, row.index_100, row.matched_pct) == (0, None, None, None)


def test_unit_prices_are_exact(spark):
    df = spark.createDataFrame(
        [("2020-01-15", "a", 0.1, 1.0), ("2020-01-20", "a", 0.2, 2.0), ("2020-02-01", "a", 1.0, 0.0), (None, "a", 1.0, 1.0), ("2020-01-01", "b", None, 1.0)],
        "d string, e string, amount double, quantity double",
    )
    found = pricevolume.unit_prices(df, date=F.to_date("d"), entity=F.col("e"), amount=F.col("amount"), quantity=F.col("quantity"))
    assert rows(found) == [(day("2020-01-01"), "a", 0.1), (day("2020-02-01"), "a", None)]


def test_a_hot_cell_is_combined_where_it_is_read(spark):
    from test_plans import executed, lines

    hot = spark.range(30_000, numPartitions=4).select(
        F.lit("2020-01-01").cast("date").alias("date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("entity"),
        F.lit(1.0).alias("x"),
    )
    matched = pricevolume.match_volumes(hot.withColumnRenamed("x", "price"), hot.withColumnRenamed("x", "volume"))
    plan = executed(matched)
    assert lines(plan, "partial_sum") and not lines(plan, "Join") and len(lines(plan, "- Exchange")) == 1
    assert matched.where("entity = 'hot'").first().volume == 10_000.0


def test_cells_dealt_over_more_tasks_are_the_same_and_shuffled_no_further(spark):
    rng = random.Random(5)
    lines = [(f"2020-{rng.randint(1, 9)}-03", rng.choice([1, 2, 3, None]), rng.choice([None, 2.5, 7.25]), rng.choice([0.0, 3.0, None])) for _ in range(400)]
    lines += [("2020-05-05", 9, 1.25, 2.0)] * 300
    df = spark.createDataFrame(lines, "d string, part long, money double, pieces double")
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = reshape.cell_tasks(df, 700 // (given + 3))
    assert tasks > given and reshape.cell_tasks(df) is None

    def matched(n):
        keys = {"date": F.to_date("d"), "entity": F.col("part")}
        prices = pricevolume.unit_prices(df, **keys, amount=F.col("money"), quantity=F.col("pieces"), tasks=n)
        volumes = reshape.to_panel(df, **keys, value=F.col("pieces"), how="sum", decimals=0, tasks=n)
        return pricevolume.match_volumes(prices, volumes.withColumnRenamed("value", "volume"))

    plain, dealt = matched(None), matched(tasks)
    assert rows(plain) == rows(dealt) and len(rows(plain)) > 20
    assert rows(pricevolume.weighted_index(plain)) == rows(pricevolume.weighted_index(dealt))
    mean = {"date": F.to_date("d"), "entity": F.col("part"), "value": F.col("money"), "decimals": 2}
    assert rows(reshape.to_panel(df, **mean)) == rows(reshape.to_panel(df, **mean, tasks=tasks))
    plan = matched(tasks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 4 and "ENSURE_REQUIREMENTS" not in plan
