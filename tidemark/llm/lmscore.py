"""Language-model scores of documents, learned from the documents that are not held out.

A baseline counts every word of the learning documents: tasks exchange, per bucket of word
hashes, which documents have a word how often, and get back each document's sum. The model
is the one of ``attention``: ids, and ids after groups of ids, are counted over all learning
documents. Its attention is trained where the stored ids lie, without an exchange: tasks train
side by side from the same parameters, which are averaged after each round. The rounds together
train on every window of every learning document, on each once. Scoring slides overlapping windows
over whole texts, so that every id is scored once.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import attention
from tidemark.llm.store import arrow_map, partitions, stored, table
from tidemark.llm.textblocks import blocks, bytes_of, lowered, word_hashes
from tidemark.llm.tokens import tokenizer, word_ids, word_memory

FOLDS, HELD_OUT = 7, 2
ROUNDS = 2
CHUNK = 8192  # windows held at a time
FLUSH_WORDS = 2_000_000
HEADER, POSTINGS, SUMS, DISTINCT = 0, 1, 2, 3
COUNT_ROW = (
    "kind int, bucket int, chunk string, docs binary, numbers binary, hashes binary, train binary, "
    "runs binary, owners binary, times binary"
)
SUM_ROW = "kind int, chunk string, docs binary, numbers binary, sums binary"


def _postings(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per chunk of documents a header, and per bucket of words who has which how often."""
    schema = pa.schema(
        [("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.string())]
        + [(n, pa.binary()) for n in ("docs", "numbers", "hashes", "train", "runs", "owners", "times")]
    )

    def rows(**columns):
        n = len(columns["kind"])
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema],
            schema=schema,
        )

    words: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    docs: list[tuple] = []

    def flush():
        h = np.concatenate(words)
        sizes = np.concatenate(lengths)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        null, ids, versions, held = (np.array(c) for c in zip(*docs))
        learn = ~held.astype(bool)
        chunk = hashlib.md5(h.tobytes() + ids.tobytes() + versions.tobytes()).hexdigest()
        head = np.stack([null.astype(np.int64), ids, versions, held.astype(np.int64), sizes + 1])
        yield rows(kind=[HEADER], bucket=[int(chunk[:8], 16) % buckets], chunk=[chunk], docs=[head.tobytes()])
        words.clear(), lengths.clear(), docs.clear()
        if not len(h):
            return
        # Who has which, in order of hash and document, as one number.
        codes, h = pd.factorize(h)
        order = np.argsort(h)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        h = h[order]
        pairs = np.sort(rank[codes] * len(sizes) + owner)
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        times = np.diff(np.append(first, len(pairs)))
        place, owner = np.divmod(pairs[first], len(sizes))
        starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        runs = np.diff(np.append(starts, len(place)))
        train = np.add.reduceat(times * learn[owner], starts)
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        spans = np.repeat(starts[by_bucket] - (np.cumsum(runs[by_bucket]) - runs[by_bucket]), runs[by_bucket])
        at = spans + np.arange(len(owner))
        h, runs, train, bucket = h[by_bucket], runs[by_bucket], train[by_bucket], bucket[by_bucket]
        owner, times = owner[at], times[at]
        cut = np.flatnonzero(np.diff(bucket)) + 1
        edges = np.append(0, np.cumsum(runs))[cut]
        pieces = {
            "hashes": np.split(h, cut), "train": np.split(train.astype(np.uint32), cut),
            "runs": np.split(runs.astype(np.uint32), cut),
            "owners": np.split(owner.astype(np.uint32), edges), "times": np.split(times.astype(np.uint32), edges),
        }
        names = bucket[np.append(0, cut)]
        yield rows(
            kind=[POSTINGS] * len(names), bucket=names, chunk=[chunk] * len(names),
            numbers=[np.array([len(sizes)]).tobytes()] * len(names),
            **{k: [x.tobytes() for x in v] for k, v in pieces.items()},
        )

    held_words = 0
    for batch, data, offsets in blocks(batches):
        found, bounds = word_hashes(lowered(data), offsets)
        words.append(found)
        lengths.append(np.diff(bounds))
        held_words += len(found) + batch.num_rows
        for doc, version, held in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "version", "held_out"))):
            docs.append((doc is None, doc or 0, version, held))
        if held_words >= FLUSH_WORDS:
            yield from flush()
            held_words = 0
    if docs:
        yield from flush()


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count the words of a task's buckets, and give every chunk its documents' sums."""
    schema = pa.schema(
        [("kind", pa.int32()), ("chunk", pa.string()), ("docs", pa.binary()), ("numbers", pa.binary()), ("sums", pa.binary())]
    )
    kept = []
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == HEADER:
                yield pa.RecordBatch.from_pylist([{k: row.get(k) for k in schema.names}], schema=schema)
            else:
                kept.append(
                    [row["chunk"], int(np.frombuffer(row["numbers"], np.int64)[0]), np.frombuffer(row["hashes"], np.uint64)]
                    + [np.frombuffer(row[k], np.uint32) for k in ("train", "runs", "owners", "times")]
                )
    if not kept:
        return
    distinct, place = np.unique(np.concatenate([k[2] for k in kept]), return_inverse=True)
    counts = np.bincount(place, np.concatenate([k[3] for k in kept]).astype(np.float64), len(distinct))
    yield pa.RecordBatch.from_pylist(
        [{"kind": DISTINCT, "numbers": np.array([np.count_nonzero(counts)]).tobytes()}], schema=schema
    )
    at = 0
    for chunk, docs, hashes, _, runs, owners, times in kept:
        count = counts[place[at : at + len(hashes)]]
        at += len(hashes)
        log = np.repeat(np.log10(count + 1), runs) * times
        known = np.repeat(count > 0, runs) * times
        sums = np.bincount(owners, log, docs)
        total = np.bincount(owners, known, docs).astype(np.int64)
        yield pa.RecordBatch.from_pylist(
            [{"kind": SUMS, "chunk": chunk, "numbers": total.tobytes(), "sums": sums.tobytes()}], schema=schema
        )


def _per_document(batches: Iterator[pa.RecordBatch], end_log: float, end_known: int, each: float):
    """Add up the sums of a task's chunks; one row per document."""
    heads, totals = {}, {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == HEADER:
                heads[row["chunk"]] = np.frombuffer(row["docs"], np.int64).reshape(5, -1)
                continue
            known, sums = np.frombuffer(row["numbers"], np.int64), np.frombuffer(row["sums"], np.float64)
            if row["chunk"] in totals:
                totals[row["chunk"]][0] += known
                totals[row["chunk"]][1] += sums
            else:
                totals[row["chunk"]] = [known.copy(), sums.copy()]
    for chunk, (null, ids, versions, held, tokens) in heads.items():
        known, sums = totals.get(chunk, [np.zeros(len(ids), np.int64), np.zeros(len(ids))])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, mask=null.astype(bool)), pa.array(versions), pa.array(held.astype(bool)),
                pa.array(tokens), pa.array(known + end_known), pa.array(sums + end_log + tokens * each),
            ],
            ["doc_id", "version", "held_out", "n_tokens", "n_known", "base_score"],
        )


def folded(docs: DataFrame) -> DataFrame:
    """``(doc_id, version, held_out, text)``: the fold follows from ``doc_id``, version from the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return docs.select(
        "doc_id", F.xxhash64(text).alias("version"),
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), text.alias("text"),
    )


def baseline(rows: DataFrame) -> DataFrame:
    """``(doc_id, version, held_out, n_tokens, n_known, train_tokens, base_score)`` of ``folded`` rows.

    Add-one word probabilities from the learning documents; every text ends with a token of
    its own. A word with very many documents is one entry per chunk of its bucket.
    """
    spark = rows.sparkSession
    buckets = partitions(spark)
    dealt = arrow_map(rows, lambda b: _postings(b, buckets), COUNT_ROW).repartition(buckets, "bucket")
    met = stored(arrow_map(dealt, _met, SUM_ROW), "lm-words")

    def totals(batches):
        for batch in batches:
            found = [(0, 0, 0)]
            for row in batch.to_pylist():
                if row["kind"] == HEADER:
                    _, _, _, held, tokens = np.frombuffer(row["docs"], np.int64).reshape(5, -1)
                    found.append((int(tokens[held == 0].sum()), int((held == 0).sum()), 0))
                elif row["kind"] == DISTINCT:
                    found.append((0, 0, int(np.frombuffer(row["numbers"], np.int64)[0])))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["n", "ends", "v"])

    small = met.where(F.col("kind").isin(HEADER, DISTINCT))
    sums = arrow_map(small, totals, "n long, ends long, v long").agg(F.sum("n"), F.sum("ends"), F.sum("v")).first()
    n, ends, distinct = (int(x or 0) for x in sums)
    distinct += ends > 0
    each = -float(np.log10(n + distinct + 1))
    end_log, end_known = float(np.log10(ends + 1)), int(ends > 0)
    of_chunks = met.where(F.col("kind").isin(HEADER, SUMS)).repartition(buckets, "chunk")
    return arrow_map(
        of_chunks,
        lambda b: _per_document(b, end_log, end_known, each),
        "doc_id long, version long, held_out boolean, n_tokens long, n_known long, base_score double",
    ).withColumn("train_tokens", F.lit(n).cast("long"))


def _ids(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Subword ids of each text, as two-byte numbers while the vocabulary allows."""
    known = word_memory(path)
    kind = id_type(path)
    for rows, data, offsets in blocks(batches):
        ids, edges = word_ids(known, data, offsets)
        ids = ids.astype(kind)
        packed = [ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("version"), rows.column("held_out"), pa.array(packed, pa.binary())],
            ["doc_id", "version", "held_out", "ids"],
        )


@functools.lru_cache(maxsize=4)
def id_type(path: str):
    return np.uint16 if tokenizer(path).get_vocab_size() < 1 << 16 else np.uint32


@functools.lru_cache(maxsize=4)
def end_id(path: str) -> int:
    """The last special id: it ends every sequence and stands before its first id."""
    return max(i for i, t in tokenizer(path).get_added_tokens_decoder().items() if t.special)


def _texts(batch: pa.RecordBatch, path: str) -> list[np.ndarray]:
    """The ids of each text of a batch, without its end."""
    data, edges = bytes_of(batch.column("ids"))
    ids = data.view(id_type(path))
    edges = (edges // ids.itemsize).tolist()
    return [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]


def _id_counts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(tokenizer(path).get_vocab_size(), np.int64)
    for batch in batches:
        counts += np.bincount(bytes_of(batch.column("ids"))[0].view(id_type(path)), minlength=len(counts))
        counts[end_id(path)] += batch.num_rows
    there = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], ["id", "n"])


@functools.lru_cache(maxsize=4)
def _ends_words(path: str) -> np.ndarray:
    """Which ids end a word."""
    final = np.zeros(tokenizer(path).get_vocab_size(), dtype=bool)
    for token, i in tokenizer(path).get_vocab().items():
        final[i] = token.endswith("</w>")
    return final


def _pair_counts(batches: Iterator[pa.RecordBatch], path: str, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """How often each id follows each group of ids, in some of this task's texts at a time."""
    groups = attention.finest(counts, _ends_words(path)).of
    end = np.array([end_id(path)], id_type(path))
    waiting, held = [], 0

    def found():
        keys = np.sort(np.concatenate(waiting))
        waiting.clear()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        times = np.diff(np.append(first, len(keys)))
        return pa.RecordBatch.from_arrays([pa.array(keys[first].astype(np.int64)), pa.array(times)], ["pair", "n"])

    for batch in batches:
        for text in _texts(batch, path):
            both = np.concatenate([end, text, end])
            waiting.append((groups[both[:-1]] * len(counts) + both[1:]).astype(np.uint32))
            held += len(text) + 1
            if held > 1 << 22:
                yield found()
                held = 0
    if waiting:
        yield found()


def _in_chunks(batch: pa.RecordBatch, path: str, chosen=None) -> Iterator[tuple[tuple, np.ndarray]]:
    """Windows of a batch of texts, and the row of each, some ``CHUNK`` at a time.

    ``chosen`` takes a row and its number of windows and returns those wanted, in ascending order.
    """
    waiting, held = [], 0

    def ready():
        rows, texts, parts = zip(*waiting)
        waiting.clear()
        return attention.gathered(texts, parts, end_id(path)), np.repeat(rows, [len(part) for part in parts])

    for row, text in enumerate(_texts(batch, path)):
        count = len(text) // attention.TARGETS + 1
        wanted = np.arange(count) if chosen is None else chosen(row, count)
        for start in range(0, len(wanted), CHUNK):
            waiting.append((row, text, wanted[start : start + CHUNK]))
            held += len(waiting[-1][2])
            if held >= CHUNK:
                yield ready()
                held = 0
    if waiting:
        yield ready()


def trained_on(version: int, count: int, turn: int, rounds: int, every: int = 1) -> np.ndarray:
    """The windows of a document that a round trains on: all rounds together have each once.

    With ``every`` above 1 they have one of so many, which one follows from the text; a document of
    fewer windows has one in the first round.
    """
    step = every * rounds
    first = version % every + turn * every
    found = np.arange(first, count, step)
    return np.array([version % count]) if not turn and not len(found) else found


def _trained(batches: Iterator[pa.RecordBatch], path: str, turn: int, rounds: int, flat: np.ndarray, model):
    """Train on this task's windows; parameters times windows, to be averaged."""
    trainer = attention.Trainer(flat, model())
    for batch in batches:
        versions = batch.column("version").to_pylist()
        for windows, _ in _in_chunks(batch, path, lambda row, count: trained_on(versions[row], count, turn, rounds)):
            trainer.train(windows)
    if trainer.windows:
        value = trainer.flat.astype(np.float64) * trainer.windows
        places, n = np.arange(len(flat)), np.full(len(flat), trainer.windows)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(value), pa.array(n)], ["at", "value", "n"])


def _model_scores(batches: Iterator[pa.RecordBatch], path: str, flat: np.ndarray, model):
    known = model()
    scorer = attention.Scorer(flat, known)
    for batch in batches:
        totals = np.zeros(batch.num_rows)
        for windows, rows in _in_chunks(batch, path):
            scores = np.concatenate(list(attention.scored_windows(flat, known, windows, scorer=scorer)))
            totals += np.bincount(rows, scores, len(totals))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("version"), pa.array(totals)], ["doc_id", "version", "score"]
        )


def model_scores(rows: DataFrame, path: str, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, version, score)``: the model's log10 probability of each ``folded`` row.

    What comes to the driver and goes to the tasks has the size of the vocabulary (counts), of the
    model (averaged parameters), or of ``GROUPS`` times the vocabulary at most (pairs), whatever the
    corpus.
    """
    ids = stored(
        arrow_map(rows, lambda b: _ids(b, path), "doc_id long, version long, held_out boolean, ids binary"), "lm-ids"
    )
    learning = ids.where("NOT held_out").select("version", "ids")
    counts = np.zeros(tokenizer(path).get_vocab_size(), np.int64)
    totals = arrow_map(learning.select("ids"), lambda b: _id_counts(b, path), "id long, n long")
    for row in totals.groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    pairs = arrow_map(learning.select("ids"), lambda b: _pair_counts(b, path, counts), "pair long, n long")
    found = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pair, times = found["pair"].to_numpy(), found["n"].to_numpy()

    name = uuid.uuid4().hex

    def model():
        return attention.kept(name, lambda: attention.Model(counts, _ends_words(path), pair, times))

    flat = attention.initial()
    for turn in range(rounds):
        given, now = flat, turn
        trained = arrow_map(
            learning, lambda b: _trained(b, path, now, rounds, given, model), "at long, value double, n long"
        )
        averaged = trained.groupBy("at").agg((F.sum("value") / F.sum("n")).alias("value")).collect()
        if averaged:
            flat = flat.copy()
            flat[[r["at"] for r in averaged]] = [r["value"] for r in averaged]
    final = flat
    return arrow_map(
        ids.select("doc_id", "version", "ids"), lambda b: _model_scores(b, path, final, model),
        "doc_id long, version long, score double",
    )


def lm_scores(docs: DataFrame, path: str, *, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    A row is held out if the crc32 of its ``doc_id`` as text leaves 2 modulo 7; rows without
    ``doc_id`` are learned from. Null text counts as empty: its end alone. Rows with the same
    ``doc_id`` and text are learned from each and score alike. An empty table gives an empty
    result; with nothing to learn from, the baseline gives every token probability one.
    """
    rows = folded(docs)
    words = baseline(rows).dropDuplicates(["doc_id", "version"])
    model = model_scores(rows, path, rounds).withColumnRenamed("doc_id", "id").withColumnRenamed("version", "of")
    same = words["doc_id"].eqNullSafe(model["id"]) & (words["version"] == model["of"])
    return model.join(words, same).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """All documents scored by the baseline and by the model."""
    import public_tokenizers

    return lm_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
