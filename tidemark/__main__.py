"""Load a commodity price file and write tables, documents and CSV copies.

    spark-submit -m tidemark prices.csv --schema prices --reports /shared/reports
    python -m tidemark prices.csv --schema prices
"""

from __future__ import annotations

import argparse
import json

from tidemark.operators.cleaning import cleaning_funnel
from tidemark.plans import answers, medallion, reports
from tidemark.plans.layout import COMMODITIES
from tidemark.session import build
from tidemark.sources.sinks import write_csv, write_json


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__.splitlines()[0])
    parser.add_argument("csv", help="file or folder of CSV files with headers")
    parser.add_argument("--schema", default="commodity_prices")
    parser.add_argument("--catalog", help="a configured catalog; default: the session's")
    parser.add_argument("--format", default="parquet", help="table format (parquet, orc, ...)")
    parser.add_argument("--location", help="folder for the schema and its tables")
    parser.add_argument("--source", help="recorded as the rows' source; default: each row's file")
    parser.add_argument("--by-year", action="store_true", help="store facts by year")
    parser.add_argument("--buckets", type=int, default=0, help="store facts by entity")
    parser.add_argument(
        "--unnumbered", action="store_true", help="no places among Bronze's control columns"
    )
    parser.add_argument(
        "--across-lines", action="store_true", help="quoted values may hold line breaks"
    )
    parser.add_argument("--infer", action="store_true", help="Bronze with types from the data")
    parser.add_argument(
        "--described", help="JSON file: dimension column -> {entity name: text of its row}"
    )
    parser.add_argument("--reports", help="folder for documents and CSV copies")
    chosen = parser.parse_args(arguments)

    described = None
    if chosen.described:
        with open(chosen.described, encoding="utf-8") as file:
            described = json.load(file)
    spark = build()
    star = medallion.run(
        spark,
        chosen.csv,
        schema=chosen.schema,
        catalog=chosen.catalog,
        source=chosen.source,
        fmt=chosen.format,
        location=chosen.location,
        numbered=not chosen.unnumbered,
        infer=chosen.infer,
        across_lines=chosen.across_lines,
        described=described,
        partition_facts=chosen.by_year,
        buckets=chosen.buckets,
    )
    if chosen.reports:
        layout = COMMODITIES
        quality = reports.quality_of_load(star.profile, star)
        analysis = reports.analysis_report(star)
        funnel = cleaning_funnel(star.profile, date=layout.date, measures=layout.measures)
        folder = chosen.reports
        write_json(reports.quality_document(quality, layout), f"{folder}/quality_report")
        write_json(reports.analysis_document(analysis, layout), f"{folder}/analysis_results")
        write_csv(funnel, f"{folder}/cleaning_funnel")
        write_csv(answers.correlation_wide(star), f"{folder}/correlation")
        write_csv(answers.outlying_moves(star), f"{folder}/outliers")
        write_csv(answers.volatility_by_year(star), f"{folder}/volatility_by_year")
        write_csv(answers.volatility_peak(star), f"{folder}/volatility_peak")
        write_csv(answers.rebased(star), f"{folder}/base_100")
        for layer in ("silver", "dimension", "monthly", "annual", "change"):
            write_csv(getattr(star, layer), f"{folder}/{layout.tables[layer]}")


if __name__ == "__main__":
    main()
