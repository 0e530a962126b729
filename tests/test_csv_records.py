"""Quoted values that go on over lines, whichever splits a file is read by."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import medallion
from tidemark.plans.layout import COMMODITIES
from tidemark.sources.readers import BLOCK, CORRUPT, FILE, ROW_ID, read_csv
from tidemark.sources.sinks import write_csv

from helpers import rows

TEXTS = ["plain", "a\nb", "\n\n", 'q"uote', 'line\n"two", x', "a,b", "", None, "back\\slash", 'end\\', "tail\n", " around\t", "é\n中"]


def table(spark, seed, n):
    rng = random.Random(seed)
    data = [(str(i), rng.choice(TEXTS), rng.choice(TEXTS)) for i in range(n)]
    return data, spark.createDataFrame(data, "key string, one string, `other text` string")


@pytest.fixture
def splits(spark):
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size", ["500", "3k", "128m"])
def test_what_is_written_is_read_back(spark, tmp_path, splits, size):
    data, df = table(spark, 3, 400)
    write_csv(df.coalesce(2), str(tmp_path / "out"))
    splits(size)
    back = read_csv(spark, str(tmp_path / "out"), across_lines=True)
    if size == "500":
        assert back.select(FILE, BLOCK).distinct().count() > 5
    assert {r[0] for r in back.select(CORRUPT).collect()} == {None}
    found = {r.key: (r.one, r["other text"]) for r in back.collect()}
    assert found == {key: rest for key, *rest_ in data for rest in [tuple(rest_)]}


def test_places_follow_the_file(spark, tmp_path, splits):
    _, df = table(spark, 5, 300)
    write_csv(df.coalesce(1), str(tmp_path / "out"))
    splits("500")
    back = read_csv(spark, str(tmp_path / "out"), across_lines=True)
    order = [int(r.key) for r in back.orderBy(FILE, BLOCK, ROW_ID).collect()]
    assert order == sorted(order) and len(order) == 300


def test_lines_alone_read_like_the_plain_reader(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\r\n1,x\r\n\r\n2\r\n3,y,z\r\n4,""\r\n5,\r\n')
    plain = read_csv(spark, str(tmp_path))
    across = read_csv(spark, str(tmp_path), across_lines=True)
    assert rows(across.select(*plain.columns)) == rows(plain)
    assert ("4", "", None) in rows(plain) and ("5", None, None) in rows(plain)


def test_header_with_line_breaks_and_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"my\nkey",v\n1,"x\ny"\n2,z\n')
    back = read_csv(spark, str(tmp_path), across_lines=True)
    assert back.columns[:2] == ["my\nkey", "v"] and rows(back.select("v")) == [("x\ny",), ("z",)]
    inferred = read_csv(spark, str(tmp_path), across_lines=True, infer=True)
    assert dict(inferred.dtypes)["my\nkey"] == "int" and inferred.count() == 2


def test_other_header_and_unpaired_quotes_are_refused(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.csv").write_text("k,v\n1,x\n")
    (tmp_path / "one" / "b.csv").write_text("v,k\nx,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(tmp_path / "one"), schema="k string, v string", across_lines=True).collect()
    (tmp_path / "c.csv").write_text('k,v\n1,"x\n2,y\n')
    with pytest.raises(Exception, match="quotes do not pair up in .*c.csv"):
        read_csv(spark, str(tmp_path / "c.csv"), across_lines=True).collect()


def test_job_reads_values_across_lines(spark, tmp_path):
    header = ",".join(f'"{name}"' for name in [*COMMODITIES.mapping, "a note"])
    body = "".join(f'2020-{m:02d}-01,{m},1,2,3,4,5,"first\nsecond, {m}"\n' for m in range(1, 13))
    (tmp_path / "raw.csv").write_text(f"{header}\n{body}2020-01-01,99,9,9,9,9,9,late\n")
    star = medallion.run(spark, str(tmp_path / "raw.csv"), schema="across", location=str(tmp_path / "t"), across_lines=True)
    assert star.silver.count() == 12 and star.monthly.count() == 60
    assert star.silver.where("mes = 1").first()[COMMODITIES.benchmark] == 1.0
    notes = spark.table("across.bronze_commodity_prices_raw").where(F.col("a_note").contains("\n"))
    assert notes.count() == 12
    spark.sql("DROP SCHEMA across CASCADE")
