import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import textblocks, tokencount, tokens
from tidemark.llm.tokencount import spliced_ids, token_counts
from tidemark.llm.tokenstore import read_tokens, token_index, write_tokens
from tidemark.session import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\t", "a", "B", "é", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "12", "!!", " ",
         " ", "́", "中", "\x1c", "😀", "word", " the"]


def encoded(path, text):
    return tokens.tokenizer(path).encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join))
def test_splicing_gives_the_ids_of_the_whole(text):
    for chunk, overlap in ((8, 2), (20, 4), (50, 16)):
        assert spliced_ids(tokens.tokenizer(BYTES), text, chunk, overlap) == encoded(BYTES, text)


def test_overlap_widens_where_no_boundary_is_stable():
    for text in ("x" * 3000, "ab " * 1000 + "y" * 500, " " * 900 + "a b"):
        assert spliced_ids(tokens.tokenizer(BYTES), text, 100, 4) == encoded(BYTES, text)


def test_counts_equal_the_library(documents, odd_texts):
    rng = random.Random(3)
    texts = [*odd_texts, *["".join(rng.choices(PARTS, k=rng.randint(0, 50))) for _ in range(300)]]
    docs = documents([*enumerate(texts), (None, "a b")], extra=("n_tokens",))
    got = {r.doc_id: r for r in token_counts(docs, BYTES, limit=20, chunk=5000, overlap=64).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts):
        n = len(encoded(BYTES, text or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 20)
    assert token_counts(documents([]), BYTES).count() == 0


def test_memory_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 50)
    known = tokens.Memory(WORDS)
    rng = random.Random(2)
    for _ in range(20):
        words = [f"w{rng.randrange(90)}".encode() for _ in range(60)]
        ids = known.ids(known.places(words))
        assert ids.tolist() == [i for w in words for i in encoded(WORDS, w.decode())]
        assert len(known.place) <= 90


def test_a_full_memory_keeps_what_it_learned_first(monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 60)
    known = tokens.WordMemory(WORDS)
    common = [f"c{i}".encode() for i in range(15)]
    learned = []
    learn = known._learn
    monkeypatch.setattr(known, "_learn", lambda new: (learned.extend(new), learn(new)))
    known.places(common)
    for i in range(12):
        words = [*common, *[f"x{i}y{k}".encode() for k in range(30)]]
        ids = known.ids(known.places(words))
        assert ids.tolist() == [i for w in words for i in encoded(WORDS, w.decode())]
        assert len(known.place) == len(known.counts) == len(known.starts) <= 60
        assert known.counts.sum() == len(known.pool)
    assert all(learned.count(word) == 1 for word in common)


ODD_WORDS = ["a", "B", "é", "ß", "É", "İ", "ı", "'s", "'", "don't", "3", "12", "²", "_", "-", ".", "...", "!?", "<|", "|>", "##", "中", "́",
             "\xa0", "\x85", "\x1c", "\x00", "\x7f", "ǆ", "ﬁ", "😀", "ñ", "ÿ", "×", "÷", "þ", "word", "the"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD_WORDS), min_size=1, max_size=6).map("".join), min_size=1, max_size=12))
def test_words_learned_together_have_their_own_ids(words):
    known = tokens.WordMemory(WORDS)
    words = [w for text in words for w in text.encode().split()]
    lowered = [w if b"<|" in w else w.lower() for w in words]
    places = known.places(lowered)
    for place, word in zip(places, words):
        assert known.ids(np.array([place])).tolist() == encoded(WORDS, word.decode())


def block_of(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *[len(d) for d in data]])


def test_words_that_differ_in_signs_are_learned_once():
    known = tokens.WordMemory(WORDS)
    texts = ["Mot mot. mot, (mot) mot2 2", "été; ÉTÉ été", "don't mot's <|mot|>"]
    ids, edges = tokens.word_ids(known, *block_of(texts))
    assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])] == [encoded(WORDS, t) for t in texts]
    pieces = {*"mot . , ( ) 2 ; été".split(), "ÉtÉ", "don't", "mot's", "<|mot|>"}
    assert {p.decode() for p in known.place} == pieces


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*ODD_WORDS, " ", "<", "|", "<|endoftext|>", "é", "Ã", "\xb7"]), max_size=8).map("".join), max_size=8))
def test_ids_of_blocks_are_those_of_the_library(texts):
    ids, edges = tokens.word_ids(tokens.word_memory(WORDS), *block_of(texts))
    parts = [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])]
    # words that only a normal form would join stand by themselves, as everywhere in the memory
    assert parts == [[i for w in re.split("([ \t-\r]+)", t) if w.strip(" \t\n\v\f\r") for i in encoded(WORDS, w)] for t in texts]


def test_marks_that_do_not_add_up_are_noticed():
    known = tokens.WordMemory(WORDS)
    known.final[:] = True
    words = [b"a.b", b"word", b"x1y2", b"plain"]
    assert known.ids(known.places(words)).tolist() == [i for w in words for i in encoded(WORDS, w.decode())]


def test_stored_ids_round_trip_in_order(spark, documents, odd_texts):
    rng = random.Random(4)
    texts = [*odd_texts, *["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(200)]]
    pairs = [(5 * i, t) for i, t in enumerate(texts)]
    rng.shuffle(pairs)
    path = scratch_path(spark, "tokens")
    write_tokens(documents(pairs, extra=("ids", "part")), WORDS, path, row_group=1 << 16)
    index = {r.doc_id: r for r in token_index(spark, path).collect()}
    start = 0
    for doc, text in sorted(pairs):
        ids = [*encoded(WORDS, text or ""), 1]
        assert (index[doc].start, index[doc].n_tokens) == (start, len(ids))
        start += len(ids)
    some = {r.doc_id: r.ids for r in read_tokens(spark, path, 20, 60).collect()}
    assert some == {d: [*encoded(WORDS, t or ""), 1] for d, t in pairs if 20 <= d <= 60}


def test_files_are_made_for_selective_reads(spark, documents, prose):
    path = scratch_path(spark, "tokens")
    write_tokens(documents([prose(i, 400) for i in range(60)]), WORDS, path, row_group=1 << 15)
    for part in Path(path.removeprefix("file:")).glob("part-*.parquet"):
        meta = pq.ParquetFile(part).metadata
        columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
        assert meta.num_row_groups > 1 or meta.num_rows < 20
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"} & set(columns["ids.list.element"].encodings)
        assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index


def test_empty_and_unnamed_documents_are_stored(spark, documents):
    path = scratch_path(spark, "tokens")
    write_tokens(documents([]), WORDS, path)
    assert token_index(spark, path).count() == 0
    path = scratch_path(spark, "tokens")
    write_tokens(documents([(None, "b"), (1, "a"), (1, "a"), (1, "c d")]), WORDS, path)
    found = token_index(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, 1, 1, 1] and found[0].start == 0


def test_word_hashes_follow_their_definition_in_little_room():
    data = np.random.default_rng(5).integers(0, 256, 1 << 20).astype(np.uint8)
    data[300_000 : 300_000 + 3 * textblocks.STRIP] = ord("x")
    offsets = np.array([0, 5, 5, 70_000, len(data)])
    assert (textblocks.lowered(data) == textblocks.LOWER[data]).all()
    tracemalloc.start()
    hashes, starts, lengths, _ = textblocks.word_spans(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(data)
    for i in [*range(0, len(starts), len(starts) // 50), int(lengths.argmax())]:
        word, total = data[starts[i] : starts[i] + lengths[i]], int(lengths[i])
        for place, byte in enumerate(word.tolist()):
            total += int(textblocks.BYTE_CODES[byte]) * pow(int(textblocks.MULTIPLIER), place + 1, 2**64)
        assert hashes[i] == textblocks.mixed(np.array([total % 2**64], np.uint64))[0]
