"""Refreshing load by load gives what a full reload of all loads gives."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import medallion
from tidemark.plans.layout import COMMODITIES
from tidemark.streaming.refresh import Refresh

from helpers import rows

COLUMNS = [*COMMODITIES.mapping, "seq"]
def order():
    return [F.col("seq").cast("int")]


def line(rng, seq, date):
    cells = [f"{rng.uniform(1, 100):.3f}" for _ in COMMODITIES.measures]
    if rng.random() < 0.15:
        cells[rng.randrange(1, 6)] = rng.choice(["", "-4", "x", "0"])
    return [date, *cells, str(seq)]


def loads(seed, n_loads=3):
    """Loads that overlap: late months, repeated months, unreadable dates."""
    rng = random.Random(seed)
    months = [f"{2000 + m // 12}-{m % 12 + 1:02d}-01" for m in range(60)]
    seq = iter(range(10**6))
    return [
        [line(rng, next(seq), rng.choice([*months, "bad"]) if rng.random() < 0.95 else None)
         for _ in range(25)]
        for _ in range(n_loads)
    ]


def frame(spark, data):
    raw = spark.createDataFrame(data, ", ".join(f"`{name}` string" for name in COLUMNS))
    return medallion.bronze(raw, "test")


def full_reload(spark, data):
    silver = medallion.silver(frame(spark, data), COMMODITIES, order())
    return medallion.Star.derive(spark, silver, COMMODITIES)


def tables(refresh, spark, star):
    for layer in ("silver", "monthly", "annual", "change"):
        expected = getattr(star, layer)
        yield layer, rows(refresh.read(spark, layer), *expected.columns), rows(expected)


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_add_up_to_a_full_reload(spark, tmp_path, seed):
    refresh = Refresh(COMMODITIES, str(tmp_path), order())
    seen = []
    for number, load in enumerate(loads(seed)):
        refresh.apply(frame(spark, load), number)
        seen += load
    for layer, found, wanted in tables(refresh, spark, full_reload(spark, seen)):
        assert [r[:4] for r in found] == [r[:4] for r in wanted], layer
        assert [r[4:] for r in found] == [pytest.approx(r[4:]) for r in wanted], layer


def test_a_repeated_load_changes_nothing(spark, tmp_path):
    refresh = Refresh(COMMODITIES, str(tmp_path), order())
    data = loads(5)
    for number, load in enumerate(data):
        refresh.apply(frame(spark, load), number)
        refresh.apply(frame(spark, load), number)
    for layer, found, wanted in tables(refresh, spark, full_reload(spark, sum(data, []))):
        assert [r[:4] for r in found] == [r[:4] for r in wanted], layer


def test_a_late_observation_alters_the_next_one_years_on(spark, tmp_path):
    refresh = Refresh(COMMODITIES, str(tmp_path), order())

    def load(number, date, price):
        cells = [price] * len(COMMODITIES.measures)
        refresh.apply(frame(spark, [[date, *cells, str(number)]]), number)
        return [r[1:] for r in rows(refresh.read(spark, "change").where("commodity_id = 1"),
                                    "commodity_id", "ano", "variacao_pct_mom")]

    assert load(0, "2000-01-01", "10") == []
    assert load(1, "2005-01-01", "30") == [(2005, 200.0)]
    assert load(2, "2002-01-01", "20") == [(2002, 100.0), (2005, 50.0)]
    assert load(3, "2004-01-01", "0") == [(2002, 100.0), (2004, -100.0)]


def test_loads_without_any_date_are_kept_in_bronze_only(spark, tmp_path):
    refresh = Refresh(COMMODITIES, str(tmp_path), order())
    cells = ["1"] * len(COMMODITIES.measures)
    refresh.apply(frame(spark, [["bad", *cells, "1"]]), 0)
    refresh.apply(frame(spark, [["2000-01-01", *cells, "2"]]), 1)
    assert spark.read.parquet(refresh.path("bronze")).count() == 2
    assert refresh.read(spark, "silver").count() == 1


def test_stream_picks_up_new_files_once(spark, tmp_path):
    source = tmp_path / "arriving"
    source.mkdir()
    refresh = Refresh(COMMODITIES, str(tmp_path / "tables"))
    header = ",".join(COLUMNS)
    cells = ",".join(["5"] * len(COMMODITIES.measures))

    def arrive(name, date):
        (source / name).write_text(f"{header}\n{date},{cells},1\n")
        refresh.stream(spark, str(source), COLUMNS).awaitTermination()
        return refresh.read(spark, "monthly").count()

    assert arrive("a.csv", "2000-01-01") == 5
    assert arrive("b.csv", "2000-02-01") == 10
    assert arrive("c.csv", "2000-02-01") == 10
    sources = spark.read.parquet(refresh.path("bronze")).select("_source").distinct()
    assert sorted(row[0].rsplit("/", 1)[1] for row in sources.collect()) == [
        "a.csv", "b.csv", "c.csv"
    ]


@pytest.mark.parametrize("broken", ["monthly", "annual", "change"])
def test_a_load_that_broke_off_is_made_whole_by_repeating_it(spark, tmp_path, monkeypatch, broken):
    refresh = Refresh(COMMODITIES, str(tmp_path), order())
    data = loads(9)
    replace = Refresh._replace

    def breaking(self, rows, layer):
        if layer == broken:
            raise RuntimeError("lost")
        replace(self, rows, layer)

    for number, load in enumerate(data):
        monkeypatch.setattr(Refresh, "_replace", breaking)
        with pytest.raises(RuntimeError, match="lost"):
            refresh.apply(frame(spark, load), number)
        monkeypatch.setattr(Refresh, "_replace", replace)
        refresh.apply(frame(spark, load), number)
    for layer, found, wanted in tables(refresh, spark, full_reload(spark, sum(data, []))):
        assert [r[:4] for r in found] == [r[:4] for r in wanted], layer


@pytest.mark.parametrize("split", ["600", "4k", "128m"])
def test_first_row_of_a_load_does_not_hang_on_splits(spark, tmp_path, split):
    header = ",".join(f'"{name}"' for name in COMMODITIES.mapping)
    (tmp_path / "raw").mkdir()
    for name, first, n in (("a", 100, 20), ("b", 900, 600)):
        lines = "".join(f"2020-01-01,{first + i},1,1,1,1,1\n" for i in range(n))
        (tmp_path / "raw" / f"{name}.csv").write_text(header + "\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        refresh = Refresh(COMMODITIES, str(tmp_path / "tables"))
        refresh.stream(spark, str(tmp_path / "raw"), list(COMMODITIES.mapping)).awaitTermination()
        assert [r.indice_precos_metais for r in refresh.read(spark, "silver").collect()] == [100.0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_late_and_a_zero_observation_change_their_successors(spark, tmp_path):
    def row(date, value, seq):
        return [date, *[str(value)] * 6, str(seq)]

    refresh = Refresh(COMMODITIES, str(tmp_path), order())
    first = [row("2000-05-01", 10, 0), row("2003-05-01", 20, 1), row("2009-05-01", 30, 2)]
    late = [row("2001-01-01", 0, 3), row("2005-01-01", 40, 4)]
    for number, load in enumerate((first, late)):
        refresh.apply(frame(spark, load), number)
    for _, found, expected in tables(refresh, spark, full_reload(spark, first + late)):
        assert found == expected


def test_changes_are_rewritten_from_pruned_years(spark, tmp_path):
    refresh = Refresh(COMMODITIES, str(tmp_path), order())
    data = [[f"{y}-0{m}-01", *[str(y + m)] * 6, str(y * 10 + m)] for y in range(2000, 2010) for m in (1, 2)]
    refresh.apply(frame(spark, data), 0)
    facts = spark.read.parquet(refresh.path("monthly"))
    plan = refresh._altered_changes(facts, [2008])._jdf.queryExecution().toString()
    windows = plan[plan.index("== Physical Plan =="):]
    assert "ano" in windows and "PartitionFilters: [isnotnull(ano" in windows
    assert {r.ano for r in refresh._altered_changes(facts, [2008]).collect()} == {2008, 2009}


def approximately(found, wanted):
    return [tuple(pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(v, float) else v for v in row) for row in wanted] == found


@pytest.mark.parametrize("compacting", [False, True])
def test_quality_and_correlation_follow_the_loads(spark, tmp_path, compacting):
    from tidemark.operators import cleaning, quality, relation
    from tidemark.operators.change import flag_outliers

    lay = COMMODITIES
    refresh = Refresh(lay, str(tmp_path), order(), fan_in=2)
    seen = []
    for number, load in enumerate(loads(3, 4)):
        refresh.apply(frame(spark, load), number)
        seen += load
        if compacting:
            refresh.compact(spark)
    bronze = frame(spark, seen)
    profile = medallion.load_profile(bronze, lay, order())
    star = full_reload(spark, seen)
    flagged = flag_outliers(star.change, entity=lay.entity, change=lay.change)
    report = quality.quality_report(profile, flagged, date=lay.date, measures=lay.measures, output=star.silver)
    assert approximately(rows(refresh.quality(spark)), rows(report))
    funnel = cleaning.cleaning_funnel(profile, date=lay.date, measures=lay.measures)
    assert rows(refresh.funnel(spark)) == rows(funnel)
    matrix = relation.correlation_matrix(star.monthly, **lay.grain).where("n > 0")
    assert approximately(rows(refresh.correlation(spark)), rows(matrix))
    index = star.silver.select(lay.date, lay.benchmark)
    related = relation.correlation_with_benchmark(star.monthly, index, **lay.grain)
    assert approximately(rows(refresh.benchmark_correlation(spark)), rows(related))
    for layer, found, wanted in tables(refresh, spark, star):
        assert [r[:4] for r in found] == [r[:4] for r in wanted], layer


def test_reports_read_no_bronze(spark, tmp_path):
    refresh = Refresh(COMMODITIES, str(tmp_path), order())
    for number, load in enumerate(loads(2, 2)):
        refresh.apply(frame(spark, load), number)
    bronze_table = COMMODITIES.tables["bronze"]
    for report in (refresh.quality(spark), refresh.funnel(spark), refresh.correlation(spark)):
        assert not any(bronze_table in file for file in report.inputFiles())
    moments = refresh.correlation(spark).inputFiles()
    assert moments and all("/moments/" in file for file in moments)


def test_moments_of_a_load_come_from_its_own_dates(spark, tmp_path):
    refresh = Refresh(COMMODITIES, str(tmp_path), order())

    def line_of(date, value, seq):
        return [date, *[str(value + k) for k in range(6)], str(seq)]

    refresh.apply(frame(spark, [line_of("2020-01-01", 5, 0), line_of("2020-02-01", 7, 1)]), 0)
    refresh.apply(frame(spark, [line_of("2020-02-01", 900, 2), line_of("2020-03-01", 6, 3)]), 1)
    parts = spark.read.parquet(refresh.path("moments"))
    assert {r.n for r in parts.where("_part LIKE '00000001-%'").collect()} == {1}
    assert {r.n for r in refresh.correlation(spark).collect()} == {3}


def test_merging_keeps_the_tables_and_bounds_the_files(spark, tmp_path):
    refresh = Refresh(COMMODITIES, str(tmp_path), order(), fan_in=2)
    seen = []
    for number, load in enumerate(loads(8, 7)):
        refresh.apply(frame(spark, load), number)
        seen += load
    before = {layer: rows(refresh.read(spark, layer)) for layer in ("silver", "monthly", "annual", "change")}
    n_bronze = refresh.read(spark, "bronze").count()
    assert refresh.compact(spark) == 4  # 7 parts: 1 + 2 + 4
    assert refresh.compact(spark) == 0
    for layer, found in before.items():
        assert rows(refresh.read(spark, layer)) == found, layer
    assert refresh.read(spark, "bronze").count() == n_bronze == len(seen)
    refresh.discard_merged(spark)
    folders = [p for p in (tmp_path / COMMODITIES.tables["bronze"]).iterdir() if p.name.startswith("_part=")]
    assert len(folders) == 3
    late = loads(8, 9)[8]
    refresh.apply(frame(spark, late), 7)  # loads go on after a merge
    for layer, found, wanted in tables(refresh, spark, full_reload(spark, seen + late)):
        assert [r[:4] for r in found] == [r[:4] for r in wanted], layer


def test_a_load_and_a_merge_side_by_side(spark, tmp_path, monkeypatch):
    """A load commits between the writing of a merged part and its commit."""
    from tidemark.sources.commits import CommitLog

    refresh = Refresh(COMMODITIES, str(tmp_path), order(), fan_in=2)
    data = loads(4, 3)
    for number in range(2):
        refresh.apply(frame(spark, data[number]), number)
    change = CommitLog.change
    arriving = [data[2]]

    def interrupted(self, edit, tries=20):
        if arriving:
            load = arriving.pop()
            refresh.apply(frame(spark, load), 2)
        return change(self, edit, tries)

    monkeypatch.setattr(CommitLog, "change", interrupted)
    assert refresh.compact(spark) == 1
    for layer, found, wanted in tables(refresh, spark, full_reload(spark, sum(data, []))):
        assert [r[:4] for r in found] == [r[:4] for r in wanted], layer


def test_loads_come_in_their_order(spark, tmp_path):
    refresh = Refresh(COMMODITIES, str(tmp_path), order())
    data = loads(4, 2)
    refresh.apply(frame(spark, data[0]), 3)
    with pytest.raises(ValueError, match="load 1 comes after load 3"):
        refresh.apply(frame(spark, data[1]), 1)
    assert refresh.read(spark, "bronze").count() == len(data[0])
