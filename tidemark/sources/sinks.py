"""Tables, CSV folders and JSON reports; each call is one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.names import quoted
from tidemark.sources.versions import VersionedTable


def ensure_schema(
    spark: SparkSession, schema: str, catalog: str | None = None, location: str | None = None
) -> str:
    """Create the schema if missing, at ``location`` if given; return its qualified name.

    A catalog is configuration in open-source Spark (``spark.sql.catalog.<name>``); it is
    used when given and never created.
    """
    qualified = quoted(schema) if catalog is None else f"{quoted(catalog)}.{quoted(schema)}"
    escaped = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = "" if location is None else f" LOCATION '{escaped}'"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {qualified}{place}")
    return qualified


def overwrite_table(
    df: DataFrame,
    name: str,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
    sort_by: str | None = None,
    path: str | None = None,
) -> None:
    """Replace a table, its schema included: the old one is dropped, then the new one written.

    ``replace_table`` does it in one step. A partitioned table is written after a rebalance on the partition columns: partitions
    get few files, and a large one is still written by several tasks. A bucketed one has
    one file per bucket; windows, groups and joins on the bucket column then read it
    without a shuffle.
    """
    if partition_by and bucket_by:
        raise ValueError("a table is either partitioned or bucketed")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if bucket_by:
        df = df.repartition(buckets, bucket_by)
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by)
        if sort_by:
            writer = writer.sortBy(bucket_by, sort_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_table(
    df: DataFrame, name: str, path: str, *, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> VersionedTable:
    """Replace the table under ``path``, and the view ``name`` over it, each in one step.

    The data of the new version are written first. A job that breaks off before its commit leaves
    table and view as they were; after it, repeating the job sets the view right. A table in the
    way of the view's name is dropped from the catalog.
    """
    spark = df.sparkSession
    table = VersionedTable(spark, path, fmt)
    folder = table.replace(df, partition_by)
    columns = ", ".join(f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in df.schema)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {fmt}.`{folder}`")
    return table


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with headers, one per task; white space around values is kept."""
    as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, **as_is).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """A folder of JSON lines; NULL fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
