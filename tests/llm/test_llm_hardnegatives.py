import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hardnegatives as hard
from tidemark.llm.hardnegatives import hard_negatives, op11_hard_negatives, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, twin string, block int"


def brute(rows, anchor, positives=5, negatives=5, percent=80):
    """All pairs; ``rows`` are distinct sound (vec_id, label, whole parts)."""
    found = []
    for a in rows:
        if not anchor(a[0]):
            continue
        scored = [
            (-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in rows if b[0] != a[0] and len(b[2]) == len(a[2])
        ]
        for p in sorted(s for s in scored if s[2] == a[1])[:positives]:
            hits = sorted(s for s in scored if s[2] != a[1] and percent * -p[0] <= 100 * -s[0] <= 100 * -p[0])
            found += [(a[0], p[1], r, s[1], -p[0], -s[0]) for r, s in enumerate(hits[:negatives], 1)]
    return sorted(found)


def vectors(seed, n, dims=16, labels=4, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, v, int(label)) for i, (v, label) in enumerate(zip(x.astype(np.float32).tolist(), rng.integers(0, labels, n)))]


def sound(rows):
    return [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]


@pytest.fixture
def frame(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)

    return make


ODD = [
    (None, [0.1] * 16, 1), (901, None, 1), (902, [0.1] * 15 + [None], 1), (903, [0.1] * 15 + [float("nan")], 1),
    (904, [0.1] * 15 + [float("inf")], 1), (905, [0.1] * 16, None), (906, [], 2), (907, [0.0] * 16, 2),
    (908, [-0.25] * 16, 3), (910, [0.2] * 5, 1), (920, [0.2] * 5, 2), (930, [0.19] * 5, 1), (940, [1.0], 0),
]


@pytest.mark.parametrize("block,group", [(16_384, 4096), (40, 8)])
def test_equal_to_all_pairs(frame, block, group, monkeypatch):
    monkeypatch.setattr(hard, "PASS_ROWS", 2 * group)  # several passes where groups are small
    made = vectors(3, 400)
    made += [(500 + i, made[0][1], i % 3) for i in range(60)] + ODD  # ties of one vector
    rows = whole_vectors(frame(made))
    got = hard_negatives(rows, rows.where(F.col("vec_id") % 10 == 0), block=block, group=group).collect()
    assert sorted(map(tuple, got)) == brute(sound(made), lambda i: i % 10 == 0)
    assert len(got) > 200


@pytest.mark.parametrize("percent,count", [(100, 3), (0, 2), (95, 1)])
def test_windows_of_any_width(frame, percent, count):
    made = vectors(9, 200, dims=3, labels=2)
    rows = whole_vectors(frame(made))
    got = hard_negatives(rows, rows.where("vec_id < 20"), percent=percent, negatives=count, positives=2).collect()
    assert sorted(map(tuple, got)) == brute(sound(made), lambda i: i < 20, 2, count, percent)


def test_large_components_are_exact_and_repeated_rows_one(frame):
    rng = random.Random(5)
    made = [(i, [float(rng.randrange(-(2**19), 2**19)) for _ in range(8)], i % 3) for i in range(60)]
    rows = whole_vectors(frame(made + made[:30] + [(99, [2.0**40] * 8, 1)]))
    assert rows.count() == 60
    got = hard_negatives(rows, rows.where("vec_id < 10")).collect()
    assert sorted(map(tuple, got)) == brute(sound(made), lambda i: i < 10)


def test_rows_of_an_id_are_different_rows(frame):
    rows = whole_vectors(frame([(0, [1.0, 0.0], 1), (0, [1.0, 0.1], 1), (1, [0.9, 0.0], 2)]))
    got = [tuple(r) for r in hard_negatives(rows, rows.where("vec_id = 0")).collect()]
    assert Counter(g[:2] for g in got) == {(0, 0): 2}  # each of the two is the other's positive


def test_registered_query_changes_labels(spark, frame, tmp_path):
    made = vectors(11, 700, labels=10)
    frame(made).write.parquet(str(tmp_path / "embeddings.parquet"))
    changed = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in made]
    got = op11_hard_negatives(spark, str(tmp_path))
    assert got.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"),
        ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint"),
    ]
    assert sorted(map(tuple, got.collect())) == brute(sound(changed), lambda i: i % 100 == 0)


def test_scan_drops_rows_before_the_last_dimension():
    rng = np.random.default_rng(1)
    values = rng.integers(-60, 60, (64, 5000)).astype(np.float64)
    block = hard.Columns.__new__(hard.Columns)
    block.values, block.low, block.high = values, values.min(axis=1), values.max(axis=1)
    anchor = values[:, 7] * np.where(np.arange(64) < 16, 8, 0.1).round()
    seen = []

    def limits(low, high):
        seen.append(len(low))
        return np.partition(low, -5)[-5] if len(low) > 5 else -np.inf, np.inf

    rows, score = hard.scan(anchor, block, np.ones(5000, bool), limits)
    assert seen[0] == 5000 and seen[-1] < 50
    assert (score == (anchor @ values[:, rows]).astype(np.int64)).all()
    assert set(np.argsort(-(anchor @ values), kind="stable")[:5]) <= set(rows)


def test_empty_tables(frame):
    rows = whole_vectors(frame([]))
    assert hard_negatives(rows, rows).count() == 0
    rows = whole_vectors(frame(vectors(1, 5)))
    assert hard_negatives(rows, rows.where("vec_id > 100")).count() == 0
