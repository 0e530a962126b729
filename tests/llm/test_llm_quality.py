import re
from collections import Counter

import corpus_pipeline
import duckdb
import pytest

from tidemark.llm.quality import quality_rules
from tidemark.llm.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), symbols, dup, len(covered), failed


def test_measures_equal_brute_force(documents, odd_texts, prose):
    texts = [*odd_texts, *[prose(i, 20 * i) for i in range(1, 12)], "one two three " * 60]
    texts += [prose(3, 40) + "\n" + prose(3, 40) + "\n" + prose(4, 9), " ".join(prose(5, 30) for _ in range(9))]
    docs = documents(texts, extra=("n_words", "kept", "m", "doc"))
    found = quality_rules(docs, keep=docs.columns).select("doc.*", "m.*", "base_failed", "kept").drop("n_words")
    got = quality_rules(docs).select("doc.doc_id", "m.*", "base_failed").collect()
    assert len(got) == len(texts) and found.count() == len(texts)
    for row in got:
        expected = measured(texts[row.doc_id])
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words,
                row.base_failed) == expected


def test_outliers_of_a_group_go_and_clean_documents_stay(documents, prose):
    clean = [prose(i, 200) for i in range(300)]
    junk = [re.sub(" ", " ### ", prose(1000 + i, 100)) for i in range(9)]
    shouting = [re.sub(" ", "!! ", prose(2000 + i, 100)) for i in range(9)]
    judged = quality_rules(documents(clean + junk + shouting))
    kept = {r.doc_id for r in judged.where("kept").select("doc.doc_id").collect()}
    assert kept == set(range(300))


def test_fences_differ_between_groups(spark):
    from tidemark.llm.quality import fences, measured as measures_of, sketches
    from tidemark.llm.store import stored, table

    measures = stored(measures_of(table(spark, "/root/testdata/sf0.1", "documents")), "measures")
    limits = fences(sketches(measures)).collect()
    high = {r.limits.word_length.high for r in limits}
    assert len(limits) > 20 and len(high) > 5


def test_null_ids_and_repeated_rows_are_judged_each(documents, prose):
    pairs = [*((i, prose(i, 200)) for i in range(30)), (None, prose(1, 200)), (None, None), (3, prose(3, 200)), (3, prose(3, 200))]
    rows = quality_rules(documents(pairs)).select("doc.doc_id", "base_failed", "kept").collect()
    assert len(rows) == 34 and Counter(r.doc_id for r in rows)[3] == 3
    assert len({(r.base_failed, r.kept) for r in rows if r.doc_id == 3}) == 1
    assert sorted(r.kept for r in rows if r.doc_id is None) == [False, True]


def test_each_rule_of_the_pipeline_rejects_its_outliers(spark, documents, prose):
    def lines(seed, copies):
        rows = [prose(seed * 50 + k, 12) for k in range(20 - copies)]
        return "\n".join(rows + [f"{rows[0]}"] * copies)

    def repeating(seed, words):
        part = prose(seed + 500, words)
        return f"{prose(seed, 100)} {part} {prose(seed + 1, 100)} {part}"

    clean = [lines(i, 0) for i in range(300)]
    junk = {
        "symbols": [re.sub(" ", "# ", lines(1000 + i, 0), count=60) for i in range(5)],
        "shouts": [re.sub(" ", "! ", lines(1010 + i, 0), count=60) for i in range(5)],
        "dup_lines": [lines(1020 + i, 5) for i in range(5)],
        "repeats": [repeating(90_000 + 2 * i, 40) for i in range(5)],
        "long words": [re.sub(" ", "", lines(1040 + i, 0), count=90) for i in range(5)],
        "short words": [re.sub(r"(\w\w)(?=\w)", r"\1 ", lines(1050 + i, 0)) for i in range(5)],
    }
    texts = clean + [t for kind in junk.values() for t in kind]
    assert not any(measured(t)[5] for t in texts)
    kept = {r.doc_id: r.text for r in corpus_pipeline.quality_stage(spark, documents(texts), "").collect()}
    left = {name: sum(t in kept.values() for t in kind) for name, kind in junk.items()}
    assert left == dict.fromkeys(junk, 0)
    assert set(kept) == set(range(300))


def test_small_groups_take_the_fences_of_their_language(documents, prose):
    docs = documents([prose(i, 200) for i in range(250)])
    few = documents([(1000, prose(7, 200)), (1001, re.sub(" ", " $$$$ ", prose(8, 200)))], source=None)
    kept = quality_rules(docs.union(few)).where("kept").select("doc.doc_id").collect()
    assert {r.doc_id for r in kept if r.doc_id >= 1000} == {1000}


def test_empty_table(documents):
    assert quality_rules(documents([])).count() == 0


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    with duckdb.connect() as connection:
        for table in ("documents", "embeddings"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        cursor = connection.execute(ORACLE[name])
        columns = [c[0] for c in cursor.description]
        wanted = sorted(cursor.fetchall(), key=repr)
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == wanted
