"""Raw CSV files and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import quoted

# Control columns of a load: file, start of the split, and row in the order of reading.
FILE, BLOCK, ROW_ID = "_source_file", "_source_block", "_row_id"


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from a file's header; reads one line, not the data."""
    return spark.read.option("header", True).csv(path).columns


# Fixed value: the column for the text of lines that do not fit the header.
CORRUPT = "_corrupt_record"


# Stands for a quoted empty text while it is read, as the CSV reader takes that for a NULL.
EMPTY = "\u0000"


def text_schema(names: list[str]) -> T.StructType:
    """Every column as text, and a last one for lines with too few or too many values."""
    return T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])


def empty_texts(rows: DataFrame) -> DataFrame:
    """``rows`` as read with ``emptyValue`` set to ``EMPTY``: quoted empty texts are empty, absent ones NULL."""
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType) and f.name != CORRUPT]
    real = {name: F.when(F.col(quoted(name)) == EMPTY, "").otherwise(F.col(quoted(name))) for name in texts}
    return rows.withColumns(real) if real else rows


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    across_lines: bool = False,
) -> DataFrame:
    """A CSV file or folder with a header row in every file.

    Each file's header is compared with the schema, so a file whose columns come in
    another order fails instead of filling the wrong columns.

    By default every column is text, so that a column's type does not hang on its worst
    value; ``infer`` asks for types from the data, at the cost of one more pass over it. Text
    columns keep a quoted empty text apart from an absent one (NULL).
    Either way ``_corrupt_record`` holds the whole text of a line whose number of values is
    not the header's; what of it fits stands in the columns.

    A line is a record, so a line break inside a quoted value cuts it in two; ``across_lines`` reads
    such values (see ``records_across_lines``) and adds the columns of a row's place.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "emptyValue": EMPTY}
    if infer:
        found = spark.read.options(header=True, inferSchema=True, multiLine=across_lines).csv(path).schema
        schema = T.StructType([*found, T.StructField(CORRUPT, T.StringType())])
    elif schema is None:
        names = csv_header(spark, path) if not across_lines else _header_across_lines(spark, path)
        schema = text_schema(names)
    if across_lines:
        return empty_texts(_parsed(records_across_lines(spark, path), schema, options))
    return empty_texts(spark.read.options(header=True, enforceSchema=False, **options).schema(schema).csv(path))


# --- records that go on over several lines -------------------------------------------------


def _quotes(line: Column) -> Column:
    """The quotes in a line, without those behind a backslash."""
    bare = F.regexp_replace(line, r"\\.", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))


def records_across_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(record, is_header, file, block, row)``: the records of CSV files, line breaks in quotes kept.

    A line begins a record if the quotes before it in its file are even in number. Each split counts
    its quotes; one row per split tells, added up along its file, how the next begins; and within
    a split the count runs from line to line. So a file is read by as many tasks as it has
    splits, and only the lines of records that are longer than one line are grouped. A record's place
    is that of its first line.

    Quotes inside a value have to be doubled or stand behind a backslash, in a quoted value. A
    file whose quotes do not pair up is refused.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW_ID),
        F.col("value").alias("line"),
        _quotes(F.col("value")).alias("quotes"),
    )
    along_file = Window.partitionBy(FILE).orderBy(BLOCK)
    before = along_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy(FILE, BLOCK).agg(F.sum("quotes").alias("in_split"))  # one row per split
    whole = Window.partitionBy(FILE)
    splits = splits.withColumns(
        {"ahead": F.coalesce(F.sum("in_split").over(before), F.lit(0)), "in_file": F.sum("in_split").over(whole)}
    )
    refused = F.raise_error(F.concat(F.lit("quotes do not pair up in "), F.col(FILE)))
    splits = splits.withColumn("ahead", F.when(F.col("in_file") % 2 == 0, F.col("ahead")).otherwise(refused))
    in_split = Window.partitionBy(FILE, BLOCK).orderBy(ROW_ID)
    so_far = in_split.rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.join(splits.select(FILE, BLOCK, "ahead"), [FILE, BLOCK])
    count = F.col("ahead") + F.coalesce(F.sum("quotes").over(so_far), F.lit(0))
    placed = placed.withColumn("inside", count % 2 == 1)
    # A line outside quotes opens a record, and is all of it if it leaves none open.
    placed = placed.withColumns(
        {
            "number": F.sum(F.when(~F.col("inside"), 1).otherwise(0)).over(in_split.rowsBetween(Window.unboundedPreceding, 0)),
            "alone": ~F.col("inside") & (F.col("quotes") % 2 == 0),
        }
    )
    is_first = (F.col(BLOCK) == 0) & (F.col("number") == 1)
    single = placed.where("alone").select(F.col("line").alias("record"), is_first.alias("is_header"), FILE, BLOCK, ROW_ID)
    # Lines that open no record of their split belong to the last one opened before it.
    parts = placed.where(~F.col("alone"))
    opened = parts.groupBy(FILE, BLOCK).agg(F.max(F.when(~F.col("inside"), F.col("number"))).alias("opened"))
    at = F.when(F.col("opened").isNotNull(), F.struct(F.col(BLOCK).alias("b"), F.col("opened").alias("n")))
    opened = opened.withColumn("carried", F.last(at, ignorenulls=True).over(before)).select(FILE, BLOCK, "carried")
    own = F.struct(F.col(BLOCK).alias("b"), F.col("number").alias("n"))
    latest = F.last(F.when(~F.col("inside"), own), ignorenulls=True).over(in_split.rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("own", latest).join(opened, [FILE, BLOCK])
    parts = parts.withColumn("of", F.coalesce("own", "carried"))
    joined = parts.groupBy(FILE, "of").agg(
        F.sort_array(F.collect_list(F.struct(BLOCK, ROW_ID, "line"))).alias("lines"),
        F.min(F.struct(BLOCK, ROW_ID)).alias("place"),
    )
    multiple = joined.select(
        F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"),
        ((F.col("of.b") == 0) & (F.col("of.n") == 1)).alias("is_header"),
        FILE,
        f"place.{BLOCK}",
        f"place.{ROW_ID}",
    )
    records = single.unionByName(multiple)
    return records.withColumn("record", F.regexp_replace("record", r"\r$", "")).where(F.trim("record") != "")


def _fields(record: Column, names: list[str], options: dict) -> Column:
    """A record's values as a struct of texts."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i, _ in enumerate(names)])
    plain = {key: value for key, value in options.items() if key != "columnNameOfCorruptRecord"}
    return F.from_csv(record, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), plain)


def _header_across_lines(spark: SparkSession, path: str) -> list[str]:
    """Column names of a header that may itself hold line breaks; reads the beginning of a file."""
    return spark.read.options(header=True, multiLine=True).csv(path).columns


def _parsed(records: DataFrame, schema: T.StructType | str, options: dict) -> DataFrame:
    """Records under the columns of ``schema``, each file's header compared with them."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = [name for name in schema.names if name != CORRUPT]
    options = {**options, "multiLine": "true"}
    header = _fields(F.col("record"), names, options)
    fits = F.lit(True)
    for i, name in enumerate(names):
        fits = fits & (F.lower(header[f"c{i}"]) == name.lower())
    refused = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema in "), F.col(FILE)))
    kept = F.when(F.col("is_header"), F.when(fits, F.lit(False)).otherwise(refused)).otherwise(F.lit(True))
    numbered = T.StructType([T.StructField(f"c{i}" if f.name != CORRUPT else CORRUPT, f.dataType) for i, f in enumerate(schema)])
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in numbered)
    values = records.where(kept).select(F.from_csv("record", ddl, options).alias("v"), FILE, BLOCK, ROW_ID)
    named = [F.col("v")[f.name].alias(name) for f, name in zip(numbered, schema.names)]
    return values.select(*named, FILE, BLOCK, ROW_ID)
