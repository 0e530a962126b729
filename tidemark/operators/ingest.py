"""Bronze: names, control columns and shape; values stay as they came."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import quoted, technical_names
from tidemark.sources.readers import BLOCK, CORRUPT, FILE, ROW_ID


def _renamed(df: DataFrame) -> dict[str, str]:
    """Original -> technical name; the reader's own columns keep theirs."""
    own = (CORRUPT, FILE, BLOCK, ROW_ID)
    names = technical_names(name for name in df.columns if name not in own)
    return {name: names.get(name, name) for name in df.columns}


def rename_to_technical(df: DataFrame) -> DataFrame:
    """Normalise every column name; the original is kept as the column's comment."""
    return df.select(
        *[
            F.col(quoted(old)).alias(new, metadata={"comment": old})
            if old != new
            else F.col(quoted(old))
            for old, new in _renamed(df).items()
        ]
    )


def rename_audit(df: DataFrame, *, counted: bool = False) -> DataFrame:
    """The columns whose name changes: ``(position, original, technical)``.

    ``counted`` adds ``n_values``, the values that stand under the new name, from one scan.
    """
    rows = [
        (position, old, new)
        for position, (old, new) in enumerate(_renamed(df).items())
        if old != new
    ]
    if not counted:
        return df.sparkSession.createDataFrame(
            rows, "position int, original string, technical string"
        )
    totals = df.agg(*[F.count(F.col(quoted(old))).alias(new) for _, old, new in rows])
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(old).alias("original"),
            F.lit(new).alias("technical"),
            F.col(new).alias("n_values"),
        )
        for position, old, new in rows
    ]
    return totals.select(F.inline(F.array(*entries)))


def stamp(df: DataFrame, source: str | None = None) -> DataFrame:
    """Add load time and source; without ``source`` the path of each row's file."""
    path = F.col(FILE) if FILE in df.columns else F.col("_metadata.file_path")
    origin = F.lit(source) if source is not None else path
    return df.withColumns({"_ingestion_timestamp": F.current_timestamp(), "_source": origin})


def locate(df: DataFrame) -> DataFrame:
    """Add each row's file and the start of its split, unless it has them. For a file scan."""
    if FILE in df.columns:
        return df
    return df.withColumns(
        {FILE: F.col("_metadata.file_path"), BLOCK: F.col("_metadata.file_block_start")}
    )


def number_rows(df: DataFrame, name: str = ROW_ID) -> DataFrame:
    """Add a number that grows with the rows of a split, to be used with its file and start.

    By itself it says nothing about different splits: those are numbered in the order in
    which they are packed into tasks, which follows their sizes and the number of cores.
    Rows that have one keep it.
    """
    if name in df.columns:
        return df
    return df.withColumn(name, F.monotonically_increasing_id())


def source_order() -> Column:
    """The order of located and numbered rows: path of the file, place in it.

    It is the same however files are split and packed, and however often a task is run.
    """
    return F.struct(*[F.col(name) for name in (FILE, BLOCK, ROW_ID)])


def shape_profile(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns, and the schema as text."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(df.schema.simpleString()).alias("schema"),
    )
