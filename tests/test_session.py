from pyspark.sql import functions as F

from types import SimpleNamespace

import pytest

from tidemark.session import discard, scratch_path, shared_folder
from tidemark.sources.sinks import ensure_schema


def test_scratch_lies_in_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    paths = {scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3 and all(path.startswith(f"{folder}/x-") for path in paths)
    spark.range(3).checkpoint()


def test_results_do_not_hang_on_the_local_time_zone(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_schema_is_created_once_at_its_place(spark, tmp_path):
    place = str(tmp_path / "place")
    name = ensure_schema(spark, "placed", location=place)
    assert name == "`placed`" == ensure_schema(spark, "placed")
    described = spark.sql(f"DESCRIBE SCHEMA {name}").where(F.col("info_name") == "Location")
    assert described.first().info_value.endswith("place")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    session = SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default)
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_scratch_is_deleted(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    discard(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
