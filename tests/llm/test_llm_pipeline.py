import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm.tokens import tokenizer

from test_llm_lines import brute as kept_texts
from test_llm_ngrams import brute as groups
from test_llm_quality import measured


@pytest.fixture(scope="module")
def docs(documents, prose, odd_texts):
    footer = "All rights reserved by nobody"
    texts = [f"{prose(i, 120)}\n{footer}" for i in range(40)]
    texts += [t.replace(t.split()[3], "changed", 1) for t in texts[:6]] + [texts[7], texts[8]]
    texts += ["### " * 80, "same same same " * 40, *odd_texts]
    return documents(texts).cache()


def test_stages_one_after_another(spark, docs):
    columns = docs.columns
    judged = corpus_pipeline.quality_stage(spark, docs, "")
    passed = {r.doc_id: r.text for r in judged.collect()}
    assert judged.columns == columns and set(range(48)) <= set(passed)
    assert not any(measured(text)[5] for text in passed.values())

    cleaned = corpus_pipeline.line_stage(spark, judged, "")
    assert cleaned.columns == columns
    wanted = dict(zip(passed, kept_texts(list(passed.items()), 10)))
    assert {r.doc_id: r.text for r in cleaned.collect()} == wanted
    assert all(r.n_chars == len(r.text) for r in cleaned.collect())

    unique = corpus_pipeline.near_duplicate_stage(spark, cleaned, "")
    assert unique.columns == columns
    left = {r.doc_id for r in unique.collect()}
    assert left == {i for i, _, c in groups(list(wanted.items()), 5, 80) if i == c}
    assert not left & set(range(40, 48))

    mixed = corpus_pipeline.mixing_stage(spark, unique, "")
    assert mixed.columns == columns
    sampled = {r.doc_id: r.text for r in mixed.collect()}
    assert set(sampled) < left and len(sampled) > 0.5 * len(left)

    packed = corpus_pipeline.packing_stage(spark, mixed, "").collect()
    assert {r.doc_id for r in packed} == set(sampled)
    words = tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ids = [len(words.encode(t, add_special_tokens=False).ids) + 1 for t in sampled.values()]
    assert sum(r.n_tokens for r in packed) == sum(ids)


def test_copies_of_a_row_and_rows_without_an_id(spark, documents, prose):
    text = prose(1, 80)
    docs = documents([(1, text), (1, text), (2, text), (None, text), (None, text)])
    found = corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == [(False, 1), (True, 0), (True, 0)]


def test_stages_take_extra_columns_of_any_name(spark, documents, prose):
    texts = [f"{prose(i % 30, 120)}\nThe end of all" for i in range(36)]
    docs = documents(texts).withColumns(
        {"version": F.lit(7).cast("long"), "doc": F.lit("d"), "m": F.lit(1.5), "kept": F.lit(True), "bin": F.array(F.lit(1)),
         "probability": F.lit("p"), "component_id": F.lit(None).cast("long"), "a b": F.col("doc_id")}
    )
    kinds = docs.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.dtypes == kinds, name
        rows = docs.collect()
        assert rows and {(r.version, r.doc, r.m, r.kept, r.probability) for r in rows} == {(7, "d", 1.5, True, "p")}
        assert all(r["a b"] == r.doc_id for r in rows)
    assert corpus_pipeline.packing_stage(spark, docs, "").count() >= docs.count()


def test_run_over_the_given_documents(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and "bin_size" in found.columns


def test_empty_table(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
