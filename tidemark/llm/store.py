"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path

ROOT = str(Path(__file__).resolve().parents[2])


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, size: int | None) -> Iterator[None]:
    """Jobs begun inside give Arrow functions batches of some ``size`` bytes, or as the session says."""
    before = spark.conf.get(BATCH_BYTES, None)
    if size:
        spark.conf.set(BATCH_BYTES, str(size))
    try:
        yield
    finally:
        if size and before is None:
            spark.conf.unset(BATCH_BYTES)
        elif size:
            spark.conf.set(BATCH_BYTES, before)


def stored(df: DataFrame, label: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    This cuts the lineage: a lost executor costs the tasks it had, and no later job
    computes the rows again. With ``batch_bytes`` the Arrow functions in ``df`` get batches of some
    such size, as batches of 10,000 texts take room several times over in the JVM and in the worker.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with batches_of(spark, batch_bytes):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The cluster's number of shuffle partitions, which sizes hash buckets as well."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by its name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` whose tasks can import this package.

    On a cluster the submitter installs the package or names it in ``--py-files``. A local
    session's workers run beside the driver and get its path.
    """
    context = df.sparkSession.sparkContext
    if context.master.startswith("local"):
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return df.mapInArrow(function, schema)
