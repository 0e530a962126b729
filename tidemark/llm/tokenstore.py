"""Token ids in Parquet files made for selective reads.

Documents are range-partitioned and sorted by id, encoded, and written as a list column of
ids beside narrow metadata. Ids are dictionary-encoded while a row group's dictionary fits
and delta-encoded beyond (format v2), row groups have a set size, and the column and offset
indexes let a reader skip pages by ``doc_id``. Metadata can be read without touching ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.store import arrow_map, partitions, table
from tidemark.llm.textblocks import blocks
from tidemark.llm.tokens import word_ids, word_memory
from tidemark.session import scratch_path

END_ID = 1
ROW_GROUP = 16 << 20
PAGE_ROWS = 1000
TOKENS = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Ids of each text and the end id, with the number of ids before it in this task."""
    known = word_memory(path)
    part = TaskContext.get().partitionId()
    before = 0
    for rows, data, offsets in blocks(batches):
        ids, edges = word_ids(known, data, offsets)
        counts = np.diff(edges) + 1
        bounds = np.append(0, np.cumsum(counts))
        full = np.full(bounds[-1], END_ID, np.int32)
        inner = np.ones(bounds[-1], dtype=bool)
        inner[bounds[1:] - 1] = False
        full[inner] = ids
        starts = before + bounds[:-1]
        before += int(bounds[-1])
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("doc_id"),
                pa.array(np.full(len(counts), part, np.int32)),
                pa.array(starts),
                pa.array(counts),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(full)),
            ],
            ["doc_id", "part", "start_in_part", "n_tokens", "ids"],
        )


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, *, row_group: int = ROW_GROUP) -> None:
    """Encode ``docs`` and write their ids in ascending order of ``doc_id`` to the folder ``path``.

    A null text has the end id alone. Rows without ``doc_id`` come first; rows with the same
    one are ordered by the hash of their text.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"))
    ranged = rows.repartitionByRange(partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    encoded = arrow_map(ranged, lambda batches: _encoded(batches, tokenizer_path), TOKENS)
    encoded.write.options(
        **{
            "parquet.writer.version": "v2",
            "parquet.enable.dictionary": "true",
            "parquet.block.size": str(row_group),
            "parquet.page.row.count.limit": str(PAGE_ROWS),
            "compression": "snappy",  # encoded ids hardly get smaller by anything slower
        }
    ).parquet(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, part, start_in_part, start, n_tokens)``; reads no ids.

    ``start`` is the number of ids of all documents before. Offsets of the parts come from
    one total per part, so the frame that is ordered by one task and broadcast has as many
    rows as the write had tasks.
    """
    rows = spark.read.schema(TOKENS).parquet(path).select("doc_id", "part", "start_in_part", "n_tokens")
    return rows.join(F.broadcast(_parts(rows)), "part").withColumn(
        "start", F.col("start_in_part") + F.col("shift")
    ).drop("shift")


def _parts(rows: DataFrame) -> DataFrame:
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``(doc_id, ids)``; with bounds, of documents from ``first`` to ``last`` by skipping pages."""
    rows = spark.read.schema(TOKENS).parquet(path).select("doc_id", "ids")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        edges = ids.offsets.to_numpy()
        data = memoryview(ids.values.to_numpy().astype("<u4")).cast("B")
        crcs = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(edges[:-1], edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("start"),
                pa.array(np.diff(edges).astype(np.int64)),
                pa.array(crcs, pa.int64()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def op9_token_store(spark, sf_dir: str) -> DataFrame:
    """Write the ids of all documents, read the files back, and digest what they hold."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    rows = spark.read.schema(TOKENS).parquet(path)
    shifts = _parts(rows)
    rows = rows.join(F.broadcast(shifts), "part").select(
        "doc_id", (F.col("start_in_part") + F.col("shift")).alias("start"), "ids"
    )
    return arrow_map(rows, _checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
