"""The whole way from a CSV file to the answers, beside a pandas twin of it."""

import contextlib
import csv
import io
import json
import random

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import quality
from tidemark.operators.change import flag_outliers, growth, mom_change
from tidemark.operators.summary import volatility
from tidemark.plans import answers, medallion, reports
from tidemark.plans.layout import COMMODITIES
from tidemark.sources.readers import CORRUPT, read_csv
from tidemark.sources.sinks import overwrite_table, write_csv, write_json

from helpers import day, rows

NAMES = {row["commodity_id"]: row["commodity_nome"] for row in COMMODITIES.entities}


def synthetic_file(path, seed=11, months=120):
    """A wide monthly file with the layout's columns, extra ones, and every kind of defect."""
    rng = random.Random(seed)
    sources = list(COMMODITIES.mapping)
    header = [sources[0], "Barley", *sources[1:], "Industrial Inputs, Price Index"]
    lines = []
    levels = {name: rng.uniform(50, 2000) for name in header[1:]}
    for m in range(months):
        date = f"{2000 + m // 12}-{m % 12 + 1:02d}-01"
        for name in levels:
            levels[name] *= rng.uniform(0.8, 1.2)
        lines.append([date, *[f"{levels[name]:.4f}" for name in header[1:]]])
    lines[3][4] = ""
    lines[7][5] = "n.a."
    lines[20][6] = "-12.5"
    lines.insert(30, [lines[29][0], *["1.0"] * (len(header) - 1)])
    lines.insert(40, ["unknown", *["1.0"] * (len(header) - 1)])
    lines.insert(50, ["2003-13-01", *["1.0"] * (len(header) - 1)])
    lines.append(["", *["1.0"] * (len(header) - 1)])
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([header, *lines])
    return len(lines), len(header)


def pandas_silver(path):
    frame = pd.read_csv(path, dtype=str)[list(COMMODITIES.mapping)]
    frame = frame.rename(columns=dict(COMMODITIES.mapping))
    date = COMMODITIES.date
    frame[date] = pd.to_datetime(frame[date], errors="coerce", format="%Y-%m-%d")
    frame = frame.dropna(subset=[date]).drop_duplicates(subset=[date])
    for name in COMMODITIES.measures:
        frame[name] = pd.to_numeric(frame[name], errors="coerce")
    valid = frame[COMMODITIES.measures].ge(0) | frame[COMMODITIES.measures].isna()
    return frame[valid.all(axis=1)].set_index(date).sort_index()


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "prices.csv"
    n_rows, n_columns = synthetic_file(path)
    star = medallion.run(spark, str(path), schema="prices", partition_facts=True)
    return star, pandas_silver(path), n_rows, n_columns, path


def test_bronze_keeps_everything_and_adds_control_columns(spark, loaded):
    _, _, n_rows, n_columns, path = loaded
    bronze = spark.table("prices.bronze_commodity_prices_raw")
    assert (bronze.count(), len(bronze.columns)) == (n_rows, n_columns + 6)
    assert {"China_import_Iron_Ore_Fines_62_FE_spot", "Industrial_Inputs_Price_Index",
            "_ingestion_timestamp", "_source"} <= set(bronze.columns)
    assert {row._source for row in bronze.select("_source").collect()} == {f"file:{path}"}
    kinds = dict(bronze.dtypes)
    assert kinds["Date"] == kinds["Copper"] == "string"
    comments = {f.name: f.metadata.get("comment") for f in bronze.schema}
    assert comments["Metals_Price_Index"] == "Metals Price Index"


def test_silver_matches_the_twin(loaded):
    star, twin, *_ = loaded
    assert star.silver.dtypes == [
        ("data_referencia", "date"), *[(name, "double") for name in COMMODITIES.measures],
        ("ano", "int"), ("mes", "int"),
    ]
    found = star.silver.toPandas().set_index("data_referencia").sort_index()
    assert list(pd.to_datetime(found.index)) == list(twin.index)
    np.testing.assert_array_equal(found[COMMODITIES.measures].to_numpy(), twin.to_numpy())


def test_both_ways_to_silver_agree(spark, loaded):
    star, *_ = loaded
    bronze = spark.table("prices.bronze_commodity_prices_raw")
    assert rows(medallion.silver(bronze, COMMODITIES)) == rows(star.silver)
    profile = medallion.load_profile(bronze, COMMODITIES)
    assert rows(medallion.silver_of(profile, COMMODITIES)) == rows(star.silver)
    with pytest.raises(ValueError, match="order_by"):
        medallion.silver(bronze.drop("_row_id"), COMMODITIES)


def test_renamed_columns_are_listed_beside_bronze(spark, loaded):
    audit = spark.table("prices.bronze_commodity_prices_raw_renamed")
    assert ("Metals Price Index", "Metals_Price_Index") in rows(audit, "original", "technical")


def test_descriptions_and_inferred_types(spark, loaded):
    star, *_, path = loaded
    text = {"descricao": {"Cobre": "metal", "Zinco": "galvaniza"}}
    other = medallion.run(spark, str(path), schema="inferred", infer=True, described=text)
    found = dict(rows(other.dimension, "commodity_nome", "descricao"))
    assert found["Cobre"] == "metal" and found["Zinco"] == "galvaniza" and found["Níquel"] is None
    assert rows(other.dimension.drop("descricao")) == rows(star.dimension)
    assert rows(other.silver) == rows(star.silver)


@pytest.mark.parametrize("numbered", [True, False])
def test_first_row_does_not_hang_on_splits(spark, tmp_path, numbered):
    header = ",".join(f'"{name}"' for name in COMMODITIES.mapping)
    for name, first, n in (("a", 100, 40), ("b", 900, 4000)):
        lines = "".join(f"2020-01-01,{first + i},1,1,1,1,1\n" for i in range(n))
        (tmp_path / f"{name}.csv").write_text(header + "\n" + lines)
    found = set()
    for i, (split, minimum) in enumerate([("2k", "16"), ("30k", "4"), ("128m", "1")]):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.minPartitionNum", minimum)
        try:
            star = medallion.run(spark, str(tmp_path), schema=f"splits_{numbered}_{i}", numbered=numbered)
            found |= {row.indice_precos_metais for row in star.silver.collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.minPartitionNum")
    assert found == {100.0}


def test_documents_of_another_layout_have_neutral_names(spark):
    from dataclasses import replace

    from tidemark.plans.testbed import SHIPMENTS

    report = spark.createDataFrame(
        [("correlation", "Extended price", "Quantity", None, 0.5), ("growth", "Quantity", None, None, 2.0)],
        "metric string, entity string, other string, day date, value double",
    )
    one = replace(SHIPMENTS, focus=("Quantity",))
    none = replace(SHIPMENTS, focus=())
    for layout, names in ((SHIPMENTS, 5), (one, 2), (none, 0)):
        document = reports.analysis_document(report, layout)
        assert document.columns[0] in ("correlation:Extended price~Quantity", "volatility")
        assert len(document.columns) == 3 + names and not any("cobre" in c for c in document.columns)


def test_bronze_without_row_numbers_has_three_control_columns(spark, loaded, tmp_path):
    star, _, n_rows, n_columns, path = loaded
    other = medallion.run(spark, str(path), schema="unnumbered", numbered=False)
    bronze = spark.table("unnumbered.bronze_commodity_prices_raw")
    assert (bronze.count(), len(bronze.columns)) == (n_rows, n_columns + 3)
    assert rows(other.silver) == rows(star.silver)


def test_bucketed_facts_are_read_without_a_shuffle(spark, loaded):
    star, *_, path = loaded
    other = medallion.run(spark, str(path), schema="bucketed", buckets=3)
    assert rows(other.change, *star.change.columns) == rows(star.change)
    for df in (
        mom_change(other.monthly, **COMMODITIES.grain),
        flag_outliers(other.change, entity="commodity_id", change="variacao_pct_mom"),
        volatility(other.change, ["ano", "commodity_id"], change="variacao_pct_mom"),
        growth(other.monthly, **COMMODITIES.grain),
    ):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            df.explain()
        assert "Exchange" not in text.getvalue()
    with pytest.raises(ValueError, match="either"):
        overwrite_table(spark.range(1), "bucketed.t", partition_by=["id"], bucket_by="id")


def test_gold_counts_and_invariants(loaded):
    star, twin, *_ = loaded
    cells = int(twin[list(COMMODITIES.entity_columns)].notna().sum().sum())
    assert star.monthly.count() == cells
    assert star.change.count() == cells - 5
    assert star.dimension.count() == 5
    assert star.annual.count() == 10 * 5
    assert set(star.monthly.columns) == {"data_referencia", "ano", "mes", "commodity_id",
                                         "preco_usd_ton"}
    assert set(star.annual.columns) == {"ano", "commodity_id", "preco_medio", "preco_minimo",
                                        "preco_maximo", "desvio_padrao"}
    assert dict(star.monthly.dtypes)["commodity_id"] == "int"
    assert dict(star.dimension.dtypes)["commodity_id"] == "int"


def test_evolution_is_ordered(loaded):
    star, twin, *_ = loaded
    found = [tuple(r) for r in answers.evolution(star).collect()]
    assert found == sorted(found)
    assert {r[1] for r in found} == {"Cobre", "Minério de Ferro"}
    assert answers.evolution(star, ["Zinco"]).count() == twin.preco_zinco_usd_ton.notna().sum()


def test_correlations_match_the_twin(loaded):
    star, twin, *_ = loaded
    wanted = twin.corr()
    column = {NAMES[key]: name for name, key in COMMODITIES.entity_columns.items()}
    for row in answers.correlation(star).collect():
        assert row.corr == pytest.approx(wanted.loc[column[row.name_a], column[row.name_b]])
    wide = answers.correlation_wide(star)
    assert wide.columns == ["name_a", *NAMES.values()] and wide.count() == 5
    for row in answers.benchmark_correlation(star).collect():
        assert row.corr == pytest.approx(
            wanted.loc[column[row.commodity_nome], "indice_precos_metais"]
        )


def pandas_changes(twin):
    return {
        key: twin[name].dropna().pct_change().dropna() * 100
        for name, key in COMMODITIES.entity_columns.items()
    }


def test_volatility_matches_the_twin(loaded):
    star, twin, *_ = loaded
    changes = pandas_changes(twin)
    ranking = answers.volatility_ranking(star).collect()
    wanted = sorted(((c.std(), NAMES[k]) for k, c in changes.items()), reverse=True)
    assert [r.commodity_nome for r in ranking] == [name for _, name in wanted]
    assert [r.volatility for r in ranking] == pytest.approx([sd for sd, _ in wanted])
    yearly = {(r.ano, r.commodity_nome): r.volatility for r in
              answers.volatility_by_year(star, list(NAMES.values())).collect()}
    peaks = {r.commodity_nome: r for r in answers.volatility_peak(star).collect()}
    for key, series in changes.items():
        by_year = series.groupby(series.index.year).std()
        for year, sd in by_year.items():
            assert yearly[year, NAMES[key]] == pytest.approx(sd)
        assert peaks[NAMES[key]].peak_ano == by_year.idxmax()


def test_extremes_and_outliers_match_the_twin(loaded):
    star, twin, *_ = loaded
    changes = pandas_changes(twin)
    moves = sorted((c, d.date(), NAMES[k]) for k, s in changes.items() for d, c in s.items())
    found = answers.extreme_moves(star, k=5).collect()
    rises = [r for r in found if r.direction == "rise"]
    falls = [r for r in found if r.direction == "fall"]
    for side, wanted in ((sorted(rises, key=lambda r: r.rank), moves[::-1][:5]),
                         (sorted(falls, key=lambda r: r.rank), moves[:5])):
        assert [(r.data_referencia, r.commodity_nome) for r in side] == [w[1:] for w in wanted]
        assert [r.variacao_pct_mom for r in side] == pytest.approx([w[0] for w in wanted])
    for sigmas in (1.0, 1.5, 3.0):
        wanted = {(d.date(), NAMES[k]) for k, s in changes.items()
                  for d, c in s.items() if abs(c - s.mean()) > sigmas * s.std()}
        found = answers.outlying_moves(star, sigmas).collect()
        assert {(r.data_referencia, r.commodity_nome) for r in found} == wanted
        sizes = [abs(r.variacao_pct_mom) for r in found]
        assert sizes == sorted(sizes, reverse=True)


def test_presented_values_are_rounded(loaded):
    star, *_ = loaded
    exact = {tuple(r)[:4]: r.variacao_pct_mom for r in answers.extreme_moves(star).collect()}
    for row in answers.extreme_moves(star, digits=1).collect():
        assert row.variacao_pct_mom == pytest.approx(exact[tuple(row)[:4]], abs=0.0501)
    ranking = answers.volatility_ranking(star, digits=2).collect()
    assert all(r.volatility == round(r.volatility, 2) for r in ranking)
    assert [r.volatility for r in ranking] == sorted((r.volatility for r in ranking), reverse=True)
    wide = answers.correlation_wide(star, digits=3).collect()
    assert {wide[i][wide[i].name_a] for i in range(5)} == {1.0}


def test_rebased_series_start_at_100(loaded):
    star, twin, *_ = loaded
    found = answers.rebased(star).collect()
    names = {r.commodity_nome for r in found}
    assert names == {"Cobre", "Minério de Ferro", "indice_precos_metais"}
    for name in names:
        series = sorted((r.data_referencia, r.index_100) for r in found if r.commodity_nome == name)
        assert series[0][1] == pytest.approx(100.0)


def test_growth_matches_the_twin(loaded):
    star, twin, *_ = loaded
    column = {NAMES[key]: name for name, key in COMMODITIES.entity_columns.items()}
    for row in answers.growth_over_period(star).collect():
        series = twin[column[row.commodity_nome]].dropna()
        assert row.growth_pct == pytest.approx((series.iloc[-1] / series.iloc[0] - 1) * 100)


def test_quality_of_the_load(spark, loaded, tmp_path):
    star, twin, n_rows, *_ = loaded
    report = reports.quality_of_load(star.profile, star)
    document = reports.quality_document(report, COMMODITIES)
    write_json(document, str(tmp_path / "quality"))
    (part,) = (tmp_path / "quality").glob("part-*.json")
    found = json.loads(part.read_text(encoding="utf-8"))
    assert found["total_linhas_bronze"] == n_rows
    assert found["total_linhas_silver"] == len(twin) == star.silver.count()
    assert found["consistencia_linhas_sem_data_valida_removidas"] == 3
    assert found["acuracia_valores_negativos_encontrados"]["preco_niquel_usd_ton"] == 1
    assert found["completude_nulos_antes_tratamento"]["data_referencia"] == 1
    assert set(found["completude_nulos_apos_tratamento"]) == set(star.silver.columns)
    assert found["periodo_coberto"] == {"inicio": "2000-01-01", "fim": "2009-12-01"}
    assert rows(quality.uniqueness({"output": star.silver}, ["data_referencia"])) == [("output", len(twin), 0, 0)]
    measured = report.where("dimension = 'uniqueness' AND stage = 'output'").select("metric", "value")
    assert rows(measured) == [("duplicated_keys", 0.0), ("surplus_rows", 0.0)]
    assert all(r.n_negative == 0 for r in
               quality.accuracy(star.silver, COMMODITIES.measures, "output").collect())


def test_analysis_document(spark, loaded, tmp_path):
    star, twin, *_ = loaded
    report = reports.analysis_report(star)
    write_json(reports.analysis_document(report, COMMODITIES), str(tmp_path / "analysis"))
    (part,) = (tmp_path / "analysis").glob("part-*.json")
    found = json.loads(part.read_text(encoding="utf-8"))
    changes = pandas_changes(twin)
    for key, series in changes.items():
        assert found["volatilidade_geral_desvio_padrao_pct"][NAMES[key]] == pytest.approx(
            series.std(), abs=0.00501
        )
    assert set(found) == {
        "correlacao_cobre_minerio_ferro", "volatilidade_geral_desvio_padrao_pct",
        "maiores_altas_mensais", "maiores_quedas_mensais", "correlacao_cobre_indice_metais",
        "correlacao_minerio_indice_metais", "crescimento_pct_periodo_cobre",
        "crescimento_pct_periodo_minerio_ferro",
    }
    moves = sorted(c for s in changes.values() for c in s)
    assert [m["variacao_pct_mom"] for m in found["maiores_altas_mensais"]] == pytest.approx(
        moves[::-1][:5]
    )
    assert [m["variacao_pct_mom"] for m in found["maiores_quedas_mensais"]] == pytest.approx(
        moves[:5]
    )
    corr = twin.corr().loc["preco_cobre_usd_ton", "preco_minerio_ferro_usd_ton"]
    assert found["correlacao_cobre_minerio_ferro"] == pytest.approx(corr, abs=0.000501)


def test_queries_written_against_the_tables_run(spark, loaded):
    star, twin, *_ = loaded
    spark.sql("USE prices")
    try:
        table = spark.sql(
            """
            SELECT c.commodity_nome, ROUND(STDDEV(f.variacao_pct_mom), 2) AS sd
            FROM gold_fato_variacao_mensal f JOIN gold_dim_commodity c USING (commodity_id)
            GROUP BY c.commodity_nome ORDER BY sd DESC
            """
        )
        assert table.count() == 5
    finally:
        spark.sql("USE default")


def test_a_second_load_replaces_the_first_and_its_schema(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS reload")
    overwrite_table(spark.range(5), "reload.t")
    overwrite_table(spark.range(3).selectExpr("id AS other", "'x' AS y"), "reload.t")
    assert rows(spark.table("reload.t")) == [(0, "x"), (1, "x"), (2, "x")]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(day("2020-01-01"), 1.5, "a,b"), (None, None, 'q"'), (None, 2.0, "")],
                               "d date, v double, t string")
    write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"))
    assert {kind for _, kind in back.dtypes} == {"string"}
    kept = [("2020-01-01", "1.5", "a,b"), (None, "2.0", ""), (None, None, 'q"')]
    assert rows(back.drop(CORRUPT)) == kept
    inferred = read_csv(spark, str(tmp_path / "out"), infer=True)
    assert dict(inferred.dtypes) == {"d": "date", "v": "double", "t": "string", CORRUPT: "string"}
    assert {r[CORRUPT] for r in inferred.collect()} == {None}


def test_a_file_with_other_columns_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("d,v\n2020-01-01,1\n")
    (tmp_path / "b.csv").write_text("v,d\n1,2020-01-01\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(tmp_path)).collect()


def test_command_line_writes_tables_and_reports(spark, loaded, tmp_path):
    from tidemark.__main__ import main

    star, *_, path = loaded
    out = tmp_path / "reports"
    main([str(path), "--schema", "by_command", "--reports", str(out), "--by-year"])
    assert rows(spark.table("by_command.silver_commodity_prices")) == rows(star.silver)
    written = {folder.name for folder in out.iterdir()}
    assert {"quality_report", "analysis_results", "correlation", "cleaning_funnel"} <= written
    assert read_csv(spark, str(out / "gold_fato_precos_anuais")).count() == star.annual.count()
