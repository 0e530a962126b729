"""Dimensions and naming of entities."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shared_folder


def literal_dimension(
    spark: SparkSession, rows: Sequence[dict], key: str, key_type: str = "int"
) -> DataFrame:
    """Rows typed in by hand as a table.

    Going through Arrow makes them a local relation whose size Spark knows, so joins
    broadcast it on Spark's own size check and need no hint.
    """
    table = pa.Table.from_pylist(list(rows))
    return spark.createDataFrame(table).withColumn(key, F.col(key).cast(key_type))


def entity_dimension(
    df: DataFrame, column: str, *, key: str = "entity_id", name: str = "entity_name"
) -> DataFrame:
    """Distinct values numbered 1, 2, ... in their order, without one task seeing them all.

    The values are range-partitioned, numbered inside their range, and shifted by the
    size of the ranges before. The range of each value is fixed by a reliable checkpoint
    (this runs a job), since two passes over it must agree.
    """
    spark = df.sparkSession
    shared_folder(spark)
    names = df.select(F.col(column).alias(name)).where(F.col(name).isNotNull()).distinct()
    ranged = names.repartitionByRange(name).select(name, F.spark_partition_id().alias("_range"))
    ranged = ranged.checkpoint()
    # One row per shuffle partition: the only frame that a single task orders.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(name))
    return ranged.join(F.broadcast(shifts), "_range").select(
        (F.col("_shift") + inside).alias(key), name
    )


def name_entities(
    fact: DataFrame, dim: DataFrame, key: str = "entity_id", where: Column | None = None
) -> DataFrame:
    """Inner join of a fact with its dimension, optionally for chosen dimension rows only.

    No hint: a small dimension is broadcast on its known or measured size, a large one is
    joined by shuffle with skewed partitions split at run time.
    """
    chosen = dim if where is None else dim.where(where)
    return fact.join(chosen, key)
