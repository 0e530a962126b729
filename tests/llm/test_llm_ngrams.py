import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ngramjoin
from tidemark.llm.components import components
from tidemark.llm.ngramjoin import drop_near_duplicates, ngram_join, overlap
from tidemark.llm.store import BATCH_BYTES, arrow_map, stored


def grams(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(pairs, size, percent):
    sets = [(i, grams(t, size)) for i, t in pairs]
    root = {i: i for i, _ in pairs if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in combinations([s for s in sets if s[0] is not None and s[1]], 2):
        if 100 * len(a & b) >= percent * len(a | b):
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def copies(prose, seed, words, n, edits):
    """Near copies of one text, among them chains whose ends are far apart."""
    rng = random.Random(seed)
    base = prose(seed, words).split()
    made = [list(base)]
    for _ in range(n):
        text = list(rng.choice(made))
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = f"edit{rng.random()}"
        made.append(text)
    return [" ".join(t) for t in made]


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_components_equal_brute_force(documents, odd_texts, prose, monkeypatch, size, percent):
    monkeypatch.setattr(ngramjoin, "PART", 8)  # split blocks of few documents, too
    texts = [*odd_texts]
    for seed, (words, n, edits) in enumerate([(200, 25, 3), (60, 20, 2), (12, 20, 1), (400, 12, 12), (6, 9, 1)]):
        texts += copies(prose, seed, words, n, edits)
    passage = prose(77, 50)
    texts += [f"{prose(300 + i, 5)} {passage} {prose(400 + i, 4)}" for i in range(15)]
    texts += ["A b C", "a B c", "a b c d"]
    pairs = [*enumerate(texts), (None, texts[-1]), (7, texts[-2])]
    random.Random(1).shuffle(pairs)
    got = ngram_join(documents(pairs, extra=("n", "a", "doc")), size=size, percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(pairs, size, percent)


def test_overlap_counts_blocks_and_stops_early():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 4000, rng.integers(1, 3000)).astype(np.uint64)) for _ in range(2))
        exact = len(np.intersect1d(a, b))
        assert overlap(a, b, 0, step=64) == exact
        least = int(rng.integers(1, 2000))
        assert (overlap(a, b, least, step=64) >= least) == (exact >= least)


def test_documents_within_the_bound_agree_in_a_block():
    rng = np.random.default_rng(1)
    for percent in (80, 90):
        for _ in range(300):
            n = int(rng.integers(1, 120))
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            drop = int(rng.integers(0, max(1, len(a) // 5) + 1))
            b = np.union1d(a[drop:], rng.integers(0, 2**63, int(rng.integers(0, 8))).astype(np.uint64))
            if len(b) and 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)):
                assert set(ngramjoin.block_hashes(a, percent)) & set(ngramjoin.block_hashes(b, percent))


def test_components_of_paths_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(9, 8), (8, 7), (7, 9), (3, 3)]
    random.Random(0).shuffle(links)
    got = dict(tuple(r) for r in components(spark.createDataFrame([*links, (None, 1)], "x long, y long")).collect())
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(500, 560)} == {500}
    assert {got[i] for i in (7, 8, 9)} == {7} and 3 not in got
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_empty_table(documents):
    assert ngram_join(documents([])).count() == 0


def test_first_of_near_duplicates_with_columns_of_any_name(spark, documents, prose):
    text, other = prose(1, 80), prose(2, 80)
    rows = [(1, text, "b", 7), (1, text, "a", 9), (1, text, "a", 8), (2, text, "c", 1), (3, other, None, None),
            (None, text, "d", 2), (None, text, "d", 2)]
    schema = "doc_id long, text string, version string, row bigint"
    docs = spark.createDataFrame(rows, schema).withColumn("place", F.lit(1)).withColumn("kept id", F.lit("x"))
    found = drop_near_duplicates(docs)
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    got = sorted((r.doc_id is None, r.doc_id or 0, r.version, r.row) for r in found.collect())
    assert got == [(False, 1, "a", 8), (False, 3, None, None), (True, 0, "d", 2), (True, 0, "d", 2)]
    assert drop_near_duplicates(docs.limit(0)).count() == 0


def test_hashing_takes_little_memory_beside_the_texts(prose):
    texts = [f"{prose(1, 4000)} {i}" for i in range(250)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(250), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    assert batch.nbytes > 4 << 20
    tracemalloc.start()
    rows = sum(x.num_rows for x in ngramjoin._incidence(iter([batch]), 5, 80, 8) if x.column("kind")[0].as_py() == 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 250 and peak < 40 << 20


def test_texts_are_sorted_once_when_duplicates_are_dropped(documents, prose):
    docs = documents([(i // 2, prose(i // 4, 30)) for i in range(40)])
    kept = drop_near_duplicates(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    sorts = [line for line in plan.splitlines() if re.search(r"\bSort \[of_id", line)]
    assert len(sorts) == 1 and "SortAggregate" not in plan
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 6, 8, 10, 12, 14, 16, 18]


def test_workers_get_batches_of_bounded_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})

    texts = spark.range(4000).selectExpr("id", "repeat('abcdefghij', 300) AS text").coalesce(1)
    before = spark.conf.get(BATCH_BYTES, None)
    found = stored(arrow_map(texts, sizes, "n long, bytes long"), "sizes", 1 << 20).collect()
    assert sum(r.n for r in found) == 4000 and max(r.bytes for r in found) < 2 << 20
    assert spark.conf.get(BATCH_BYTES, None) == before
