import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import linededup
from tidemark.llm.linededup import drop_lines, kept_lines, line_bitmaps, line_key, with_bitmaps


def brute(texts, min_documents):
    keys = Counter()
    for text in {(i, t or "") for i, t in texts}:
        keys.update({line_key(line.encode()) for line in text[1].split("\n")})
    return [
        "\n".join(line for line in (t or "").split("\n")
                  if not line_key(line.encode()) or keys[line_key(line.encode())] < min_documents)
        for _, t in texts
    ]


@pytest.fixture
def texts(odd_texts):
    rng = random.Random(5)
    lines = ["Shared", " shared\t", "SHARED ", "Über", "über", "rare", "", "a b"] + [f"l{i}" for i in range(30)]
    made = ["\n".join(rng.choices(lines, k=rng.randint(1, 12))) for _ in range(80)]
    return list(enumerate([*odd_texts, *made])) + [(None, "Shared\nx"), (None, "Shared\nx"), (3, "shared")]


@pytest.mark.parametrize("least", [2, 10])
def test_lost_lines_equal_brute_force(documents, texts, least):
    docs = documents(texts, extra=("version", "keep", "doc"))
    bitmaps = line_bitmaps(docs.select("doc_id", "text"), min_documents=least)
    cleaned = drop_lines(docs, bitmaps)
    assert cleaned.columns == docs.columns
    got = Counter((r.doc_id, r.text or "", r.n_chars) for r in cleaned.collect())
    expected = brute(texts, least)
    wanted = Counter((i, e, None if t is None else len(e)) for (i, t), e in zip(texts, expected))
    assert got == wanted
    digests = with_bitmaps(docs.select("doc_id", "text"), bitmaps).select("doc.*", "n_dropped", "keep")
    for row in digests.collect():
        kept = kept_lines((row.text or "").encode(), row.keep)
        assert hashlib.sha256(kept).digest()  # a bitmap fits its text
        assert (row.text or "").count("\n") - kept.count(b"\n") in (row.n_dropped or 0, (row.n_dropped or 1) - 1)


def test_keep_first_leaves_the_first_occurrence(documents):
    docs = documents([(2, "a\nb\na"), (1, "b\na"), (3, "c\nA ")])
    bitmaps = line_bitmaps(docs.select("doc_id", "text"), min_documents=2, keep_first=True)
    got = {r.doc_id: r.text for r in drop_lines(docs, bitmaps).collect()}
    assert got == {1: "b\na", 2: "", 3: "c"}


def test_runs_add_up_wherever_batches_and_tasks_are_cut():
    rng = random.Random(1)
    rows = sorted({(rng.randrange(4), 0, rng.choice([None, *range(30)]) or -1, 0, rng.randrange(3)) for _ in range(300)})
    totals = Counter(h for h, *_ in {(r[0], r[2]) for r in rows})
    for step in (1, 7, 1000):
        for cut in (0, 60, 150):
            while cut and rows[cut - 1][:3] == rows[cut][:3]:
                cut += 1  # no document of a hash crosses the bound between two tasks
            found = Counter()
            for part in (rows[:cut], rows[cut:]):
                batches = [
                    pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*part[i : i + step]), [pa.int64()] * 4 + [pa.int32()])],
                        ["h1", "h2", "doc_id", "version", "place"],
                    )
                    for i in range(0, len(part), step)
                ]
                for out in linededup._runs(iter(batches), 1):
                    for h, n in zip(out.column("h1").to_pylist(), out.column("n_documents").to_pylist()):
                        found[h] += n
            assert found == totals


def test_empty_table(documents):
    docs = documents([])
    assert line_bitmaps(docs.select("doc_id", "text")).count() == 0
    assert drop_lines(docs, line_bitmaps(docs.select("doc_id", "text"))).count() == 0
