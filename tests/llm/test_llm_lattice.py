import itertools
import math
import random

import numpy as np
import pytest

from tidemark.llm import lattice
from tidemark.llm.lattice import cells, near_vectors, nearest_e8, shortest


def test_decoding_finds_the_nearest_point():
    points = np.concatenate([np.zeros((1, 8)), shortest()])
    assert len(points) == 241 and np.allclose((shortest() ** 2).sum(axis=1), 2)
    x = np.random.default_rng(0).normal(size=(2000, 8)) * 0.45
    found = nearest_e8(x)
    best = ((x[:, None] - points[None]) ** 2).sum(axis=2).min(axis=1)
    assert np.allclose(((x - found) ** 2).sum(axis=1), np.minimum(best, ((x - found) ** 2).sum(axis=1)))
    assert (((x - found) ** 2).sum(axis=1) <= best + 1e-9).all()
    near = cells(x, 8)
    assert len({tuple(c) for c in near[0].tolist()}) == 8 and np.array_equal(near[:, 0], found)


def brute(rows, cosine):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))

    units = [unit(v) if i is not None and label is not None else None for i, v, label in rows]
    links, root = [0] * len(rows), {r[0]: r[0] for r in rows}
    for a, b in itertools.combinations(range(len(rows)), 2):
        if units[a] is None or units[b] is None or rows[a][2] != rows[b][2] or len(units[a]) != len(units[b]):
            continue
        if units[a] @ units[b] >= cosine:
            links[a] += 1
            links[b] += 1
            x, y = rows[a][0], rows[b][0]
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    return sorted(
        ((i, n, None if i is None else find(i), i is not None and find(i) == i) for (i, _, _), n in zip(rows, links)),
        key=repr,
    )


@pytest.mark.parametrize("block", [8, 256])
def test_links_and_components_equal_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows = []
    for label in (0, 1):
        for _ in range(30):
            base = rng.normal(size=24)
            for _ in range(int(rng.integers(1, 9))):
                rows.append((len(rows), (base + rng.normal(size=24) * 0.05).tolist(), label))
    hot = rng.normal(size=24)
    rows += [(len(rows) + i, hot.tolist(), 1) for i in range(40)]
    rows += [(len(rows) + i, (hot + rng.normal(size=24) * 0.02).tolist(), 1) for i in range(60)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 24, 1), (n + 2, [None, 1.0], 0), (n + 3, [math.nan] * 24, 0),
             (n + 4, [math.inf] * 24, 0), (n + 5, [], 0), (n + 6, hot.tolist(), None), (None, hot.tolist(), 1),
             (n + 7, hot.tolist()[:5], 1), (n + 8, (2 * hot).tolist(), 1)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    df = df.selectExpr("*", "1 AS node", "2 AS cell")
    got = sorted((tuple(r) for r in near_vectors(df, block=block).collect()), key=repr)
    assert got == brute(rows, 0.93)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        x = rng.normal(size=64)
        x /= np.linalg.norm(x)
        u = rng.normal(size=64)
        u -= (u @ x) * x
        y = 0.9301 * x + math.sqrt(1 - 0.9301**2) * u / np.linalg.norm(u)
        rows += [(2 * i, x.tolist(), 0), (2 * i + 1, y.tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert near_vectors(df).where("n_links > 0").count() >= 0.97 * len(rows)


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
