"""Hard negatives by a vertical scan of vectors.

Vectors are dealt over blocks that keep each dimension as a column, with the least and the
largest value of it. An anchor reads the columns of a block in the order of its own largest
components first. After every few columns, what the remaining ones can still add lies between
their bounds, so rows that can no longer reach the anchor's limits leave the candidate bitmap;
the last ones have their exact score. The first scan finds an anchor's positives, whose
scores are limited from below by the block's best so far; the second finds the negatives in the
score windows that the positives open.

The anchors are taken in passes of a bounded number, whose packed groups are broadcast to the
blocks: a pass reads every block once, and no pair of rows is shuffled. From each meeting of a
group with a block come a few best rows, which a ranking over all blocks cuts before it shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import arrow_map, partitions, stored, table
from tidemark.session import scratch_path

BLOCK_ROWS = 16_384
GROUP_ROWS = 4096
PASS_ROWS = 65_536  # anchors that are broadcast at once
STEP = 8  # dimensions between two looks at the bounds
SCALE = 256.0
LARGEST = 2.0**28  # of a whole component, so that scores of many dimensions fit a long

FOUND = "anchor_id long, anchor_twin long, window int, vec_id long, twin long, score long"
PACKED = "block long, dims int, ids binary, twins binary, labels binary, columns array<binary>"
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


# --- rows and blocks -----------------------------------------------------------------------


def whole_vectors(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """``(vec_id, twin, label, parts)`` of the rows that take part, with whole components.

    ``parts`` is ``floor(scale * x)`` for each component as double. Rows take no part whose id, label or
    vector is null, whose vector is empty, or holds a null or non-finite component or one whose whole
    part is over ``LARGEST``. ``twin`` tells rows of an id apart; equal rows are one.
    """
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale).cast("double")))
    sound = F.expr(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND"
        f" forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(double(x)) * {scale!r}D <= {LARGEST!r}D)"
    )
    rows = vectors.where(sound).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.xxhash64("label", "embedding").alias("twin"),
        F.col("label").cast("long").alias("label"),
        scaled.alias("parts"),
    )
    return rows.groupBy("vec_id", "twin").agg(F.first("label").alias("label"), F.first("parts").alias("parts"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a block become one row with a column of bytes for each dimension.

    Blocks have a bounded number of rows, which are held together.
    """
    held, key = [], None

    def block():
        rows = pa.Table.from_batches(held).combine_chunks()
        dims = key[1]
        matrix = rows["parts"].combine_chunks().flatten().to_numpy().astype("<i4").reshape(-1, dims)
        columns = [np.ascontiguousarray(matrix[:, d]).tobytes() for d in range(dims)]
        listed = [rows[c].combine_chunks().to_numpy().astype("<i8").tobytes() for c in ("vec_id", "twin", "label")]
        packed = {"block": pa.array([key[0]], pa.int64()), "dims": pa.array([dims], pa.int32())}
        packed |= {name: pa.array([x], pa.binary()) for name, x in zip(("ids", "twins", "labels"), listed)}
        packed["columns"] = pa.array([columns], pa.list_(pa.binary()))
        if "windows" in rows.column_names:
            packed["windows"] = pa.array([rows["windows"].to_pylist()], pa.list_(pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(list(packed.values()), list(packed))

    for batch in batches:
        numbers, dims = batch.column("block").to_numpy(), batch.column("dims").to_numpy()
        edges = np.flatnonzero((numbers[1:] != numbers[:-1]) | (dims[1:] != dims[:-1])) + 1
        for a, b in zip(np.append(0, edges).tolist(), np.append(edges, len(numbers)).tolist()):
            if a == b:
                continue
            if held and key != (numbers[a], dims[a]):
                yield block()
                held = []
            key = (numbers[a], dims[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield block()


def _in_blocks(rows: DataFrame, count: int, size: int) -> DataFrame:
    """Rows packed in blocks of some ``size``, dealt by a hash of the row whatever its label."""
    numbers = -(-count // size)
    dealt = rows.select(
        "*",
        F.pmod(F.xxhash64("twin", "vec_id"), F.lit(numbers)).alias("block"),
        F.size("parts").alias("dims"),
    ).repartition(min(numbers, partitions(rows.sparkSession)), "block")
    schema = PACKED + (", windows array<array<long>>" if "windows" in rows.columns else "")
    return arrow_map(dealt.sortWithinPartitions("block", "dims", "vec_id", "twin"), _packed, schema)


class Columns:
    """A packed block: a column for each dimension, with its least and largest value."""

    def __init__(self, row: dict):
        self.ids, self.twins, self.labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "twins", "labels"))
        self.values = np.array([np.frombuffer(c, "<i4") for c in row["columns"]]).astype(np.float64)
        self.low, self.high = self.values.min(axis=1), self.values.max(axis=1)


def dot(a: np.ndarray, values: np.ndarray, exact: bool) -> np.ndarray:
    """``a`` times ``values``, in doubles where they hold all whole numbers that can occur."""
    return a @ values if exact else a.astype(np.int64) @ values.astype(np.int64)


def scan(anchor: np.ndarray, block: Columns, alive: np.ndarray, limits) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``alive`` that stay within limits to the end, and their exact scores.

    ``limits(low, high)`` takes the bounds of the scores of the rows still alive and returns the
    least and the largest score of use.
    """
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order]
    ends = a[:, None] * np.stack([block.low[order], block.high[order]], axis=1)
    # What columns from each place on add at least and at most.
    least = np.append(np.cumsum(ends.min(axis=1)[::-1])[::-1], 0)
    most = np.append(np.cumsum(ends.max(axis=1)[::-1])[::-1], 0)
    exact = np.abs(ends).max(axis=1).sum() < 2.0**52
    rows = np.flatnonzero(alive)
    score = np.zeros(len(rows), np.float64 if exact else np.int64)
    for start in range(0, len(a), STEP):
        if not len(rows):
            break
        stop = min(start + STEP, len(a))
        part = block.values[order[start:stop]]
        score = score + dot(a[start:stop], part if len(rows) == part.shape[1] else part[:, rows], exact)
        low, high = (score + least[stop], score + most[stop])
        down, up = limits(low, high)
        stay = (high >= down) & (low <= up)
        if not stay.all():
            rows, score = rows[stay], score[stay]
    return rows, score.astype(np.int64)


def best(block: Columns, rows: np.ndarray, score: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` rows: higher scores first, then smaller ids."""
    return np.lexsort((block.twins[rows], block.ids[rows], -score))[:count]


# --- the two scans -------------------------------------------------------------------------


def _positives(anchor: np.ndarray, me: tuple, block: Columns, count: int):
    """The best ``count`` other rows of the anchor's label in a block."""
    alive = (block.labels == me[2]) & ~((block.ids == me[0]) & (block.twins == me[1]))

    def limits(low, high):
        if len(low) <= count:
            return -np.inf, np.inf
        return np.partition(low, len(low) - count)[len(low) - count], np.inf

    rows, score = scan(anchor, block, alive, limits)
    first = best(block, rows, score, count)
    return [(0, rows[first], score[first])]


def _negatives(anchor: np.ndarray, me: tuple, block: Columns, opened: list, count: int):
    """For each window ``(number, least, largest)`` its best ``count`` rows of another label in a block."""
    down, up = min(w[1] for w in opened), max(w[2] for w in opened)
    rows, score = scan(anchor, block, block.labels != me[2], lambda low, high: (down, up))
    order = best(block, rows, score, len(rows))
    falling = -score[order]
    found = []
    for number, least, largest in opened:
        a = np.searchsorted(falling, -largest, side="left")
        b = np.searchsorted(falling, -least, side="right")
        found.append((number, rows[order[a : min(b, a + count)]], score[order[a : min(b, a + count)]]))
    return found


def _met(batches: Iterator[pa.RecordBatch], count: int, percent: int | None) -> Iterator[pa.RecordBatch]:
    """Each row is a block of vectors beside a group of anchors, with their windows for negatives."""
    for row in (r for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
        block, group = Columns(row), Columns(row["anchors"])
        found = []
        for i, vector in enumerate(group.values.T):
            me = (group.ids[i], group.twins[i], group.labels[i])
            if percent is None:
                hits = _positives(vector, me, block, count)
            else:  # 100 * score >= percent * positive, in whole numbers
                opened = [(w + 1, -(-percent * s // 100), s) for w, s in enumerate(row["anchors"]["windows"][i])]
                hits = _negatives(vector, me, block, opened, count) if opened else []
            for number, rows, score in hits:
                names = np.repeat(np.array([[me[0]], [me[1]], [number]]), len(rows), axis=1)
                found.append((*names, block.ids[rows], block.twins[rows], score))
        if found:
            columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
            columns[2] = columns[2].cast(pa.int32())
            names = ["anchor_id", "anchor_twin", "window", "vec_id", "twin", "score"]
            yield pa.RecordBatch.from_arrays(columns, names)


def _ranked(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` over all blocks; Spark limits them before it shuffles them."""
    order = Window.partitionBy("anchor_id", "anchor_twin", "window").orderBy(F.desc("score"), "vec_id", "twin")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _against(blocks: DataFrame, groups: DataFrame, passes: int, each: int, count: int, percent: int | None) -> DataFrame:
    """Every group of anchors beside every block of the same dimensions, ``each`` groups at a time.

    The groups of a pass are bounded in number and size, so they are broadcast.
    """
    spark = blocks.sparkSession
    path = scratch_path(spark, "best-of-blocks")
    for number in range(passes):
        now = groups.where(F.floor(F.col("block") / each) == number)
        now = now.select(F.col("dims").alias("of_dims"), F.struct(*groups.columns).alias("anchors"))
        work = blocks.join(F.broadcast(now), F.col("dims") == F.col("of_dims"))
        work = work.select("ids", "twins", "labels", "columns", "anchors")
        arrow_map(work, lambda b: _met(b, count, percent), FOUND).write.parquet(f"{path}/pass={number}")
    return spark.read.schema(FOUND).parquet(path)


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    *,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
    block: int = BLOCK_ROWS,
    group: int = GROUP_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` and ``anchors`` are of ``whole_vectors``, the anchors being some of the rows. An anchor's positives
    are its best other rows of the same label by whole inner product, ties by smaller ``vec_id``. For
    each, the best rows of another label are returned that score at least ``percent`` of 100 of the
    positive's score and no more than it.

    Only vectors of the same length meet. An anchor without other rows of its label, or without rows
    in a window, gives no rows, as does an empty table. Rows with the same ``vec_id`` and another label
    or vector are different rows, ordered by ``twin``.
    """
    spark = rows.sparkSession
    rows = stored(rows.select("vec_id", "twin", "label", "parts"), "whole-vectors")
    anchors = stored(anchors.select("vec_id", "twin", "label", "parts"), "anchors")
    count, anchored = rows.count(), anchors.count()
    if not count or not anchored:
        return spark.createDataFrame([], RESULT)
    each = max(PASS_ROWS // group, 1)
    passes = -(-anchored // (group * each))
    blocks = stored(_in_blocks(rows, count, block), "vector-blocks")
    groups = stored(_in_blocks(anchors, anchored, group), "anchor-groups")
    best_positives = stored(_ranked(_against(blocks, groups, passes, each, positives, None), positives), "positives")
    in_order = F.sort_array(F.collect_list(F.struct("rank", "score")))  # at most ``positives``
    windows = best_positives.groupBy(F.col("anchor_id").alias("w_id"), F.col("anchor_twin").alias("w_twin")).agg(
        F.transform(in_order, lambda x: x["score"]).alias("windows")
    )
    of = (F.col("vec_id") == F.col("w_id")) & (F.col("twin") == F.col("w_twin"))
    opened = anchors.join(windows, of).drop("w_id", "w_twin")
    groups = stored(_in_blocks(opened, anchored, group), "anchor-windows")
    found = _ranked(_against(blocks, groups, passes, each, negatives, percent), negatives)
    named = best_positives.select(
        F.col("anchor_id").alias("p_anchor"),
        F.col("anchor_twin").alias("p_twin"),
        F.col("rank").alias("p_window"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    of = (
        (F.col("anchor_id") == F.col("p_anchor"))
        & (F.col("anchor_twin") == F.col("p_twin"))
        & (F.col("window") == F.col("p_window"))
    )
    return found.join(named, of).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Every hundredth vector against all, a seventh of them under a changed label."""
    vectors = table(spark, sf_dir, "embeddings")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = whole_vectors(vectors.select("vec_id", changed.alias("label"), "embedding"))
    return hard_negatives(rows, rows.where(F.col("vec_id") % 100 == 0))
