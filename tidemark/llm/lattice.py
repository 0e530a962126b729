"""Near duplicates among vectors, found through cells of the E8 lattice.

Each table projects a unit vector at random to eight dimensions and decodes it to the
nearest point of the E8 lattice; besides that cell it probes the neighbouring cells (the
240 shortest lattice vectors away) that are nearest. Vectors of one label that share a cell
of any table are compared by cosine in double precision.

A cell with many vectors is split into blocks, and its work into pairs of blocks, so no
task gets more than two blocks at a time. A pair that meets in several cells is counted in
the least of them, which both can tell from their own lists: no pair leaves its task.
What does are counts per vector and links that keep the components.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.groups import whole_groups
from tidemark.llm.store import arrow_map, partitions, stored, table
from tidemark.llm.textblocks import mixed

TABLES = 4
PROBES = 8
SCALE = 1.0
BLOCK = 256
SEED = 20_240_817


@functools.lru_cache(maxsize=1)
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for signs in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = signs
            found.append(v)
    halves = itertools.product((0.5, -0.5), repeat=8)
    found += [np.array(h) for h in halves if sum(x < 0 for x in h) % 2 == 0]
    return np.array(found)


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Integer points with an even sum nearest to the rows of ``x``."""
    point = np.rint(x)
    error = x - point
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    worst = np.abs(error[odd]).argmax(axis=1)
    point[odd, worst] += np.where(error[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 shifted by a half: the nearer of the two nearest points."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


def cells(x: np.ndarray, probes: int) -> np.ndarray:
    """The cell of each row and its nearest neighbours, ``(rows, probes, 8)``."""
    home = nearest_e8(x)
    ahead = (x - home) @ shortest().T
    near = np.argpartition(-ahead, probes - 2, axis=1)[:, : probes - 1]
    return np.concatenate([home[:, None], home[:, None] + shortest()[near]], axis=1)


def cell_names(units: np.ndarray, group: np.ndarray, tables: int, probes: int, scale: float) -> np.ndarray:
    """Sorted 64-bit names of all cells of unit vectors; ``group`` keeps labels apart."""
    names = []
    weights = mixed(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)
    for number in range(tables):
        random = np.random.default_rng([SEED, number, units.shape[1]])
        projection = random.normal(size=(units.shape[1], 8)) * scale
        at = units @ projection + random.random(8)
        points = (cells(at, probes) * 2).astype(np.int64).astype(np.uint64)
        names.append(mixed((points * weights).sum(axis=2) + mixed(group + np.uint64(number))[:, None]))
    return np.sort(np.concatenate(names, axis=1).view(np.int64), axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def _placed(batches: Iterator[pa.RecordBatch], tables: int, probes: int, scale: float):
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):  # vectors of different lengths are never compared
            part = batch.filter(pa.array(dims == dim))
            vectors = _matrix(part.column("vector"))
            units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            group = mixed(part.column("label_key").to_numpy().view(np.uint64) + np.uint64(dim))
            names = cell_names(units, group, tables, probes, scale)
            flat = pa.array(names.ravel())
            offsets = pa.array(np.arange(0, names.size + 1, names.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("node"),
                    part.column("copies"),
                    pa.array([u.tobytes() for u in units], pa.binary()),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                ["node", "copies", "unit", "cells"],
            )


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least name that each row of ``a`` shares with the same row of ``b``."""
    least = a[:, 0].copy()
    rest = np.flatnonzero(a[:, 0] != b[:, 0])
    for start in range(0, len(rest), 4096):
        part = rest[start : start + 4096]
        both = (a[part][:, :, None] == b[part][:, None, :]).any(axis=2)
        least[part] = np.where(both, a[part], np.iinfo(np.int64).max).min(axis=1)
    return least


def _group(cell: int, split: bool, block, nodes, copies, units, names, cosine: float):
    """Links of one pair of blocks: (counts per row, component label per row)."""
    linked = units @ units.T >= cosine
    np.fill_diagonal(linked, False)
    if split:
        linked &= block[:, None] != block[None, :]
    r, c = np.nonzero(np.triu(linked))
    own = _first_common(names[r], names[c]) == cell
    counts = np.bincount(r[own], copies[c[own]], len(nodes)) + np.bincount(c[own], copies[r[own]], len(nodes))
    label = nodes.copy()
    while len(r):
        least = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        lower = np.minimum(label, least)
        if (lower == label).all():
            break
        label = lower
    return counts.astype(np.int64), label


def _compared(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Compare the vectors of each (cell, one block, other block), which come one after another."""
    for rows, bounds in whole_groups(batches, ("cell", "one", "other")):
        cell, one, other, nodes, copies, block = (
            rows[c].to_numpy() for c in ("cell", "one", "other", "node", "copies", "block")
        )
        units = [np.frombuffer(u.as_buffer(), np.float64) for u in rows["unit"]]
        names = rows["cells"].combine_chunks().flatten().to_numpy().reshape(len(cell), -1)
        found = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a < 2:
                continue
            counts, label = _group(
                cell[a], one[a] != other[a], block[a:b], nodes[a:b], copies[a:b],
                np.array(units[a:b]), names[a:b], cosine,
            )
            hit = np.flatnonzero((counts > 0) | (label != nodes[a:b]))
            found.append((nodes[a:b][hit], counts[hit], label[hit]))
        if found:
            columns = [np.concatenate(x) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["node", "n_links", "label"])


def near_vectors(
    vectors: DataFrame,
    *,
    cosine: float = 0.93,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
    block: int = BLOCK,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``.

    Rows link when their labels are equal and their cosine is at least ``cosine``, as far as
    they share a cell: with the defaults over 99 % of pairs at 0.93 and practically all
    closer ones do. ``n_links`` counts other rows, ``component_id`` is the least ``vec_id``
    reached, ``kept`` tells whether that is the row itself.

    Null labels, and vectors that are null, empty, zero or hold null or non-finite
    components, link with nothing. A row without ``vec_id`` links with nothing, has no
    component and is not kept. Equal vectors of a label are compared as one.
    """
    spark = vectors.sparkSession
    sound = F.expr(
        "vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0"
        " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(embedding, x -> x != 0)"
    )
    rows = vectors.select(
        "vec_id", "label", "embedding", F.coalesce(sound, F.lit(False)).alias("sound")
    )
    key = [F.xxhash64("label", "embedding"), F.xxhash64(F.lit(SEED), "embedding", "label")]
    keyed = rows.where("sound").select("vec_id", key[0].alias("k0"), key[1].alias("k1"), "label", "embedding")
    distinct = keyed.groupBy("k0", "k1").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"),
        F.first("label").alias("label"), F.first("embedding").alias("vector"),
    )
    distinct = distinct.select(
        "k0", "k1", "node", "copies", "vector", F.xxhash64("label").alias("label_key"), F.size("vector").cast("long").alias("dim")
    )
    distinct = stored(distinct, "vectors")
    placed = stored(
        arrow_map(
            distinct.select("node", "copies", "vector", "label_key", "dim"),
            lambda b: _placed(b, tables, probes, scale),
            "node long, copies long, unit binary, cells array<long>",
        ),
        "vector-cells",
    )
    members = placed.select("node", F.explode("cells").alias("cell")).distinct()
    sizes = members.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = members.join(sizes, "cell").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = members.select(
        "cell", "node", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    )
    pairs = pairs.select(
        "cell", "node", "block", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other")
    )
    work = pairs.join(placed, "node").repartition(partitions(spark), "cell", "one", "other")
    work = work.sortWithinPartitions("cell", "one", "other").select(
        "cell", "one", "other", "block", "node", "copies", "unit", "cells"
    )
    links = stored(arrow_map(work, lambda b: _compared(b, cosine), "node long, n_links long, label long"), "vector-links")
    counts = links.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    equal = keyed.select("vec_id", "k0", "k1").join(
        distinct.select("k0", "k1", "node", "copies"), ["k0", "k1"]
    )
    equal = stored(equal.select("vec_id", "node", "copies"), "vector-copies")
    joined = components(
        links.where("node != label").select("node", "label").union(equal.where("vec_id != node").select("vec_id", "node"))
    ).toDF("member", "component")
    per_row = equal.join(counts, "node", "left").select(
        "vec_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    result = per_row.join(joined, F.col("vec_id") == F.col("member"), "left").select(
        "vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id")
    )
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if_kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return result.union(alone).withColumn("kept", if_kept)


def op4_near_vectors(spark, sf_dir: str) -> DataFrame:
    """All vectors with the number of their links and their component."""
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)
