import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import (
    change,
    conform,
    dimension,
    ranking,
    relation,
    reshape,
    summary,
)

from helpers import day, rows

MONTHS = [f"{2015 + m // 12}-{m % 12 + 1:02d}-01" for m in range(60)]


def random_rows(seed, entities="abcd", gaps=0.2):
    rng = random.Random(seed)
    return [
        (month, entity, round(rng.uniform(1, 100), 2))
        for month in MONTHS
        for entity in entities
        if rng.random() > gaps
    ]


def twin(data):
    frame = pd.DataFrame(data, columns=["date", "entity", "value"])
    return frame.sort_values(["entity", "date"]).reset_index(drop=True)


# --- reshape --------------------------------------------------------------------------


def test_to_panel_means_and_sums(spark):
    df = spark.createDataFrame(
        [("2020-01-05", "a", 1.1), ("2020-01-20", "a", 2.2), ("2020-02-01", "a", 5.0),
         (None, "a", 9.0), ("2020-01-01", None, 9.0), ("2020-03-01", "b", None),
         ("2020-02-09", "a", math.nan)],
        "d string, e string, v double",
    )
    keys = {"date": F.to_date("d"), "entity": F.col("e"), "value": F.col("v")}
    expected = [(day("2020-01-01"), "a", 1.65), (day("2020-02-01"), "a", 5.0),
                (day("2020-03-01"), "b", None)]
    for decimals in (None, 2):
        found = rows(reshape.to_panel(df, **keys, decimals=decimals))
        assert [r[:2] for r in found] == [r[:2] for r in expected]
        assert found[0][2] == pytest.approx(1.65) and found[2][2] is None
    daily = reshape.to_panel(df, **keys, how="sum", grain="day")
    assert len(rows(daily)) == 5
    with pytest.raises(ValueError):
        reshape.to_panel(df, **keys, how="median")
    with pytest.raises(ValueError):
        reshape.to_panel(df, **keys, grain="fortnight")


def test_exact_panel_does_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    data = [("2020-01-01", rng.choice("aaab"), round(rng.uniform(0, 1e6), 2)) for _ in range(3000)]
    df = spark.createDataFrame(data, "d string, e string, v double")
    keys = {"date": F.to_date("d"), "entity": F.col("e"), "value": F.col("v"), "decimals": 2}
    results = [rows(reshape.to_panel(df.repartition(n), **keys)) for n in (1, 3, 7)]
    assert results[0] == results[1] == results[2]


def test_unpivot_has_one_row_per_present_cell(spark):
    wide = spark.createDataFrame(
        [("2020-01-01", 1.0, None), ("2020-02-01", 2.0, 3.0), ("2020-03-01", None, None)],
        "d string, `x.1` double, y double",
    )
    long = reshape.unpivot_long(wide, ids=["d"], measures={"x.1": 1, "y": 2})
    assert dict(long.dtypes)["entity"] == "int"
    assert rows(long) == [("2020-01-01", 1, 1.0), ("2020-02-01", 1, 2.0), ("2020-02-01", 2, 3.0)]
    named = reshape.unpivot_long(wide, ids=["d"], measures={"x.1": "a", "y": "b"}, entity="e")
    assert rows(named.select("e").distinct()) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        reshape.unpivot_long(wide, ids=["d"], measures={"x.1": 1, "y": 1})


def test_pivot_and_unpivot_are_inverse(spark, panel):
    data = random_rows(1)
    wide = reshape.pivot_wide(panel(data), list("abcd"))
    long = reshape.unpivot_long(wide, ids=["date"], measures={e: e for e in "abcd"})
    assert rows(long) == sorted((day(d), e, v) for d, e, v in data)


def test_pivot_cell_is_the_mean(panel):
    wide = reshape.pivot_wide(panel([("2020-01-01", "a", 1.0), ("2020-01-01", "a", 3.0)]), ["a"])
    assert rows(wide) == [(day("2020-01-01"), 2.0)]


# --- change ---------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mom_matches_pandas(panel, seed):
    data = random_rows(seed)
    frame = twin(data)
    frame["change"] = frame.groupby("entity")["value"].pct_change() * 100
    frame = frame.dropna()
    found = rows(change.mom_change(panel(data)), "entity", "date", "change_pct")
    wanted = sorted((e, day(d), c) for d, e, _, c in frame.itertuples(index=False))
    assert [f[:2] for f in found] == [w[:2] for w in wanted]
    assert [f[2] for f in found] == pytest.approx([w[2] for w in wanted])
    assert len(found) == len(data) - 4


def test_change_bridges_gaps_and_survives_zero(panel):
    data = [("2020-01-01", "a", 2.0), ("2020-02-01", "a", None), ("2020-03-01", "a", 3.0),
            ("2020-04-01", "a", 0.0), ("2020-05-01", "a", 5.0), ("2020-06-01", "a", 10.0),
            ("2020-01-01", "one", 1.0)]
    found = rows(change.mom_change(panel(data)), "date", "change_pct")
    assert found == [(day("2020-03-01"), 50.0), (day("2020-04-01"), -100.0),
                     (day("2020-06-01"), 100.0)]


def test_change_refuses_a_timestamp_grain(spark):
    df = spark.createDataFrame([("a", 1.0)], "entity string, value double").withColumn(
        "date", F.current_timestamp()
    )
    with pytest.raises(TypeError, match="DATE"):
        change.mom_change(df)


def test_outliers_against_brute_force(panel):
    rng = random.Random(5)
    data = []
    for entity in "abc":
        value = 100.0
        for month in MONTHS:
            value *= rng.choice([1.5, 0.6]) if rng.random() < 0.05 else rng.uniform(0.98, 1.02)
            data.append((month, entity, value))
    data += [(month, "flat", 7.0) for month in MONTHS]
    value = 1.0
    for month in MONTHS:
        data.append((month, "steady", value))
        value *= 1.1
    frame = twin(data)
    frame["change"] = frame.groupby("entity")["value"].pct_change() * 100
    frame = frame.dropna()
    wanted = set()
    for entity, group in frame[~frame.entity.isin(["flat", "steady"])].groupby("entity"):
        mean, sd = group.change.mean(), statistics.stdev(group.change)
        moves = zip(group.date, group.change)
        wanted |= {(entity, day(d)) for d, c in moves if abs(c - mean) > 3 * sd}
    flagged = change.outliers(panel([r for r in data if r[1] != "steady"]))
    assert wanted and {(r.entity, r.date) for r in flagged.collect()} == wanted
    assert change.outliers(panel([r for r in data if r[1] == "flat"])).count() == 0


def test_rebase_starts_at_100_at_the_first_present_value(panel):
    data = [("2020-01-01", "a", None), ("2020-02-01", "a", 4.0), ("2020-03-01", "a", 5.0),
            ("2020-01-01", "z", 0.0), ("2020-02-01", "z", 3.0)]
    found = rows(change.rebase(panel(data)), "entity", "date", "index_100")
    assert found == [("a", day("2020-02-01"), 100.0), ("a", day("2020-03-01"), 125.0),
                     ("z", day("2020-01-01"), None), ("z", day("2020-02-01"), None)]


def test_growth_uses_the_first_and_last_present_values(panel):
    data = [("2020-01-01", "a", None), ("2020-02-01", "a", 4.0), ("2020-03-01", "a", 9.0),
            ("2020-04-01", "a", 5.0), ("2020-05-01", "a", None), ("2020-01-01", "z", 0.0)]
    assert rows(change.growth(panel(data))) == [("a", 4.0, 5.0, 25.0), ("z", 0.0, 0.0, None)]


# --- summary --------------------------------------------------------------------------


def test_annual_stats_match_pandas(panel):
    data = random_rows(4) + [("2030-01-01", "a", 5.0)]
    stats = summary.annual_stats(conform.calendar_parts(panel(data)))
    frame = twin(data)
    frame["year"] = frame.date.str[:4].astype(int)
    wanted = frame.groupby(["year", "entity"])["value"].agg(["mean", "min", "max", "std"])
    found = {(r.year, r.entity): r for r in stats.collect()}
    assert len(found) == len(wanted)
    for key, row in wanted.iterrows():
        got = found[key]
        assert (got.mean_value, got.min_value, got.max_value) == pytest.approx(
            (row["mean"], row["min"], row["max"])
        )
        assert got.min_value <= got.mean_value <= got.max_value
        if math.isnan(row["std"]):
            assert got.sd_value is None
        else:
            assert got.sd_value == pytest.approx(row["std"])
    assert found[(2030, "a")].sd_value is None


def test_peak_prefers_the_earliest_of_equals_and_knows_flat_series(spark):
    df = spark.createDataFrame(
        [("a", 2001, 2.0), ("a", 2002, 5.0), ("a", 2003, 5.0), ("a", 2004, None),
         ("flat", 2001, 0.0), ("flat", 2002, 0.0), ("new", 2004, None)],
        "entity string, year int, volatility double",
    )
    assert rows(summary.peak_period(df)) == [("a", 2002, 5.0), ("flat", None, 0.0),
                                             ("new", None, None)]


# --- ranking --------------------------------------------------------------------------


def test_extremes_break_ties_and_rank_each_direction(spark):
    df = spark.createDataFrame(
        [("2020-01-01", "b", 5.0), ("2020-01-01", "a", 5.0), ("2020-02-01", "a", -1.0),
         ("2020-03-01", "a", 2.0), ("2020-04-01", "a", -3.0)],
        "date string, entity string, change_pct double",
    )
    top = ranking.extremes(df, k=2)
    assert rows(top, "direction", "rank", "entity", "change_pct") == [
        ("fall", 1, "a", -3.0), ("fall", 2, "a", -1.0), ("rise", 1, "a", 5.0), ("rise", 2, "b", 5.0)
    ]
    assert ranking.extremes(df, k=50).count() == 10


def test_extremes_per_entity(panel):
    data = random_rows(6)
    moves = change.mom_change(panel(data))
    top = ranking.extremes_per_entity(moves, k=2)
    found = rows(top, "entity", "direction", "rank", "change_pct")
    by_entity = {}
    for row in moves.collect():
        by_entity.setdefault(row.entity, []).append(row.change_pct)
    wanted = [(e, direction, i + 1, c) for e in sorted(by_entity)
              for direction, down in (("fall", False), ("rise", True))
              for i, c in enumerate(sorted(by_entity[e], reverse=down)[:2])]
    assert found == wanted


def test_largest_first_orders_by_size(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 3.0), (3, 5.0)], "id int, c double")
    assert [r.id for r in ranking.largest_first(df, "c", "id").collect()] == [1, 3, 2]


# --- relation -------------------------------------------------------------------------


@pytest.mark.parametrize("entities", [3, 8, 21])
def test_correlation_matrix_matches_pandas(panel, entities):
    rng = random.Random(entities)
    data = [(month, key, rng.gauss(key, 1 + key % 3)) for month in MONTHS
            for key in range(1, entities + 1) if rng.random() > 0.3]
    found = {(r.entity_a, r.entity_b): r for r in relation.correlation_matrix(
        panel(data, "int"), entity="entity").collect()}
    wide = twin(data).pivot(index="date", columns="entity", values="value")
    wanted = wide.corr()
    assert len(found) == entities**2
    for (a, b), row in found.items():
        assert row.corr == pytest.approx(wanted.loc[a, b], abs=1e-9)
        assert row.n == (wide[a].notna() & wide[b].notna()).sum()
        assert row.corr == found[b, a].corr
        assert a != b or row.corr == pytest.approx(1.0)


def test_correlation_keys_may_be_large_or_negative(panel):
    keys = [-9, -1, 0, 7, 8, 2**60 + 1, 2**60 + 2]
    rng = random.Random(2)
    data = [(month, key, rng.random()) for month in MONTHS for key in keys]
    found = relation.correlation_matrix(panel(data, "long"), entity="entity").collect()
    assert {(r.entity_a, r.entity_b) for r in found} == {(a, b) for a in keys for b in keys}


def test_pairs_without_a_common_date_and_entities_without_values_are_cells(panel):
    data = [(m, 1, float(i)) for i, m in enumerate(MONTHS[:5])]
    data += [(m, 2, float(i)) for i, m in enumerate(MONTHS[5:10])] + [(MONTHS[0], 11, None)]
    for salts in (1, 16):
        found = {(r.entity_a, r.entity_b): (r.corr, r.n) for r in relation.correlation_matrix(
            panel(data, "int"), entity="entity", salts=salts).collect()}
        assert len(found) == 9 and found[1, 2] == found[2, 1] == found[11, 11] == (None, 0)
        assert found[1, 1] == (pytest.approx(1.0), 5)
    chosen = relation.correlation_matrix(panel(data, "int"), entity="entity", entities=[1, 11])
    assert {(r.entity_a, r.entity_b) for r in chosen.collect()} == {(1, 1), (1, 11), (11, 1), (11, 11)}


def test_correlation_of_a_constant_series_is_null(panel):
    data = [(m, 1, 5.0) for m in MONTHS] + [(m, 2, float(i)) for i, m in enumerate(MONTHS)]
    found = rows(relation.correlation_matrix(panel(data, "int"), entity="entity"))
    assert [r[2] for r in found] == [None, None, None, pytest.approx(1.0)]


def test_benchmark_alignment_and_correlation(spark, panel):
    data = random_rows(8)
    index = {m: float(i) for i, m in enumerate(MONTHS) if i % 5}
    benchmark = spark.createDataFrame(list(index.items()), "d string, level double").select(
        F.to_date("d").alias("date"), "level"
    )
    aligned = relation.align_benchmark(panel(data), benchmark)
    assert rows(aligned, "date", "entity", "benchmark") == sorted(
        ((day(d), e, index.get(d)) for d, e, _ in data),
        key=lambda r: [(v is None, v) for v in r],
    )
    related = relation.correlation_with_benchmark(panel(data), benchmark)
    found = {r.entity: r for r in related.collect()}
    for entity in "abcd":
        pairs = [(v, index[d]) for d, e, v in data if e == entity and d in index]
        assert found[entity].n == len(pairs)
        assert found[entity].corr == pytest.approx(np.corrcoef(np.array(pairs).T)[0, 1])


def test_several_benchmark_values_of_a_date_do_not_multiply_rows(spark, panel):
    data = [("2020-01-01", "a", 1.0), ("2020-02-01", "a", 2.0)]
    benchmark = panel([("2020-01-01", "x", 1.0), ("2020-01-01", "x", 3.0)]).drop("entity")
    aligned = relation.align_benchmark(panel(data), benchmark)
    assert rows(aligned, "date", "benchmark") == [(day("2020-01-01"), 2.0),
                                                  (day("2020-02-01"), None)]
    with pytest.raises(TypeError, match="DATE"):
        relation.align_benchmark(panel(data), benchmark.withColumn("date", F.current_timestamp()))


# --- dimensions -----------------------------------------------------------------------


def test_entity_dimension_numbers_in_order_without_gaps(spark):
    names = [f"n{i:04d}" for i in range(1000)]
    data = [(n,) for n in names for _ in range(2)] + [(None,)]
    random.Random(1).shuffle(data)
    dim = dimension.entity_dimension(spark.createDataFrame(data, "x string"), "x")
    assert rows(dim, "entity_id", "entity_name") == [(i + 1, n) for i, n in enumerate(names)]


def test_name_entities_drops_unknown_keys(spark):
    fact = spark.createDataFrame([(1, 5.0), (9, 6.0)], "entity_id int, value double")
    dim = dimension.literal_dimension(
        spark, [{"entity_id": 1, "entity_name": "x"}, {"entity_id": 2, "entity_name": "y"}],
        "entity_id",
    )
    assert dict(dim.dtypes)["entity_id"] == "int"
    assert rows(dimension.name_entities(fact, dim)) == [(1, 5.0, "x")]
    chosen = dimension.name_entities(fact, dim, where=F.col("entity_name") == "y")
    assert chosen.count() == 0
