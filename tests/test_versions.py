"""Tables replaced in one step: what breaks off leaves the old table, repeating is harmless."""

import threading

import pytest
from pyspark.sql import functions as F

from tidemark.sources import sinks
from tidemark.sources.commits import CommitLog, Conflict
from tidemark.sources.sinks import overwrite_table, replace_table
from tidemark.sources.versions import VersionedTable

from helpers import rows


def test_numbers_are_given_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.last() == (0, {})
    assert log.append(0, {"x": 1}) == 1
    with pytest.raises(Conflict):
        log.append(0, {"x": 2})
    number, content = log.last()
    assert number == 1 and content["x"] == 1 and content["at"] > 1.7e9
    assert not [p for p in (tmp_path / "log").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_changes_made_side_by_side_all_count(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))

    def add(n):
        log.change(lambda content: {"seen": [*content.get("seen", []), n]}, tries=100)

    threads = [threading.Thread(target=add, args=(n,)) for n in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(log.last()[1]["seen"]) == list(range(8))


def test_versions_can_be_read_by_number_and_time(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(LookupError):
        table.read()
    table.replace(spark.range(3))
    table.replace(spark.range(2).selectExpr("'x' AS name", "id AS year"), ["year"])
    assert rows(table.read()) == [("x", 0), ("x", 1)]
    assert rows(table.read(version=1)) == [(0,), (1,), (2,)]
    first, second = table.history()
    assert table.read(as_of=first["at"]).columns == ["id"]
    assert table.read(as_of=second["at"] + 5).columns == ["name", "year"]
    with pytest.raises(LookupError):
        table.read(as_of=first["at"] - 1)


def test_a_job_that_dies_between_write_and_commit_changes_nothing(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))
    staged = table.stage(spark.range(100))  # and then it dies
    assert table.read().count() == 3
    table.replace(spark.range(4))
    assert table.read().count() == 4
    assert table.discard(keep=1) == []  # all are young
    assert staged.folder in table.discard(keep=1, hours=0)
    assert table.read().count() == 4


def test_a_replaced_view_shows_the_old_table_until_the_commit(spark, tmp_path, monkeypatch):
    spark.sql("CREATE SCHEMA IF NOT EXISTS swapped")
    path = str(tmp_path / "t")
    replace_table(spark.range(3), "swapped.t", path)
    commit = VersionedTable.commit
    monkeypatch.setattr(VersionedTable, "commit", lambda self, staged: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        replace_table(spark.range(5), "swapped.t", path)
    assert spark.table("swapped.t").count() == 3
    with pytest.raises(Exception, match="lost"):  # a task that fails while the new version is written
        replace_table(spark.range(5).select(F.raise_error(F.lit("lost")).alias("id")), "swapped.t", path)
    assert spark.table("swapped.t").count() == 3
    monkeypatch.setattr(VersionedTable, "commit", commit)
    new = spark.range(5).selectExpr("id AS `the key`", "CAST(id % 2 AS STRING) AS part")
    replace_table(new, "swapped.t", path, partition_by=["part"])
    assert rows(spark.table("swapped.t")) == [(i, str(i % 2)) for i in range(5)]
    assert dict(spark.table("swapped.t").dtypes) == {"the key": "bigint", "part": "string"}


def test_a_table_of_an_earlier_load_gives_way_to_the_view(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS swapped")
    overwrite_table(spark.range(2), "swapped.before")
    replace_table(spark.range(7), "swapped.before", str(tmp_path / "t"))
    assert spark.table("swapped.before").count() == 7


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    spark.sql("CREATE SCHEMA IF NOT EXISTS swapped")
    table = replace_table(spark.range(3), f"swapped.{fmt}_t", str(tmp_path / "t"), fmt=fmt)
    assert rows(table.read()) == rows(spark.table(f"swapped.{fmt}_t")) == [(0,), (1,), (2,)]


def test_no_format_has_a_branch_of_its_own():
    assert "delta" not in open(sinks.__file__).read()
