"""Line deduplication that passes bitmaps, not text, from task to task.

Every line becomes one row of its key's 128-bit hash, its document and its place. The rows
are range-partitioned by hash and document and sorted by hash, document and place; a task
streams through its range and reports each run of equal hashes: how many documents it
spans, and its first occurrence. The range bounds split a hash with very many documents
over several tasks, whose reports add up since no document of a hash crosses a bound. What
comes back for a document is a compressed bitmap of the lines to keep.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import arrow_map, partitions, stored, table

SPACE = b" \t\n\x0b\x0c\r"
OCCURRENCE = "h1 long, h2 long, doc_id long, version long, place int, n_lines int"
RUN = "h1 long, h2 long, n_documents long, first struct<doc_id: long, version: long, place: int>"
BITMAP = "doc_id long, version long, n_dropped long, keep binary"


def line_key(line: bytes) -> bytes:
    """The line stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased."""
    return line.strip(SPACE).lower()


def _lines(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """A row per line whose key has ``min_chars`` code points; others are never dropped."""
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        versions = batch.column("version").to_pylist()
        texts = batch.column("text").cast(pa.large_binary())
        digests, owners, places, totals = [], [], [], []

        def rows() -> pa.RecordBatch:
            halves = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
            columns = [
                pa.array(halves[:, 0]),
                pa.array(halves[:, 1]),
                pa.array([ids[i] for i in owners], pa.int64()),
                pa.array([versions[i] for i in owners], pa.int64()),
                pa.array(places, pa.int32()),
                pa.array(totals, pa.int32()),
            ]
            for done in (digests, owners, places, totals):
                done.clear()
            return pa.RecordBatch.from_arrays(
                columns, ["h1", "h2", "doc_id", "version", "place", "n_lines"]
            )

        for i, text in enumerate(texts):
            lines = text.as_py().split(b"\n")
            for place, line in enumerate(lines):
                key = line_key(line)
                if len(key) >= min_chars and (
                    min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars
                ):
                    digests.append(xxhash.xxh3_128_digest(key))
                    owners.append(i)
                    places.append(place)
                    totals.append(len(lines))
                    if len(digests) == 1 << 17:
                        yield rows()
        if digests:
            yield rows()


def _runs(batches: Iterator[pa.RecordBatch], min_documents: int) -> Iterator[pa.RecordBatch]:
    """Stream sorted occurrences; report runs of enough documents, and those at the bounds.

    The first and the last run of a task may go on in its neighbours and are reported
    whatever they count. Only the open run is held from one batch to the next.
    """
    open_run = None  # [key, documents, last document, first occurrence]
    at_bound = True

    def report(found):
        h1, h2, counts, docs, versions, places = zip(*found)
        first = pa.StructArray.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(versions, pa.int64()), pa.array(places, pa.int32())],
            ["doc_id", "version", "place"],
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(counts, pa.int64()), first],
            ["h1", "h2", "n_documents", "first"],
        )

    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
        doc = batch.column("doc_id").fill_null(0).to_numpy()
        null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        version, place = batch.column("version").to_numpy(), batch.column("place").to_numpy()
        new_key = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
        new_doc = new_key.copy()
        new_doc[1:] |= (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]) | (null[1:] != null[:-1])
        starts = np.flatnonzero(new_key)
        counts = np.add.reduceat(new_doc.astype(np.int64), starts)
        ends = np.append(starts[1:], n) - 1
        found = []
        for k in _worth(counts, min_documents):
            start, end = starts[k], ends[k]
            key = (int(h1[start]), int(h2[start]))
            at = (None if null[start] else int(doc[start]), int(version[start]), int(place[start]))
            tail = (None if null[end] else int(doc[end]), int(version[end]))
            run = [key, int(counts[k]), tail, at]
            if open_run and open_run[0] == key:
                run[1] += open_run[1] - (open_run[2] == at[:2])
                run[3] = open_run[3]
                open_run = None
            if open_run:
                if at_bound or open_run[1] >= min_documents:
                    found.append((*open_run[0], open_run[1], *open_run[3]))
                at_bound = False
                open_run = None
            if k == len(starts) - 1:
                open_run = run
            elif at_bound or run[1] >= min_documents:
                found.append((*run[0], run[1], *run[3]))
                at_bound = False
        if found:
            yield report(found)
    if open_run:
        yield report([(*open_run[0], open_run[1], *open_run[3])])


def _worth(counts: np.ndarray, least: int) -> np.ndarray:
    """The runs to look at one by one: large enough, or first or last of the batch."""
    chosen = counts >= least
    chosen[[0, -1]] = True
    return np.flatnonzero(chosen)


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for places, total in zip(batch.column("places"), batch.column("n_lines").to_pylist()):
            keep = np.ones(total, dtype=bool)
            keep[places.values.to_numpy()] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes()))
        dropped = pa.array([len(p) for p in batch.column("places").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("version"), dropped, pa.array(maps, pa.binary())],
            ["doc_id", "version", "n_dropped", "keep"],
        )


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (null is empty) and ``version``, the hash of the text.

    Rows with the same ``doc_id`` and text are one document, and get the same result; rows
    with the same ``doc_id`` and different texts are different documents, as are rows
    without ``doc_id``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("version"), text.alias("text"))


def line_bitmaps(
    docs: DataFrame, *, min_documents: int = 10, min_chars: int = 1, keep_first: bool = False
) -> DataFrame:
    """``(doc_id, version, n_dropped, keep)`` for the documents that lose a line.

    A line is lost if its key (see ``line_key``) has at least ``min_chars`` code points and is
    found in at least ``min_documents`` documents; with ``keep_first`` its first occurrence by
    ``doc_id``, then text hash and place stays. ``keep`` is a zlib-compressed bitmap, highest bit
    first, of the lines to keep.

    Null text is one empty line, which is never lost. An empty table gives no rows.
    """
    spark = docs.sparkSession
    occurrences = stored(
        arrow_map(identified(docs), lambda batches: _lines(batches, min_chars), OCCURRENCE), "lines"
    )
    by = ["h1", "h2", "doc_id", "version"]
    ranged = occurrences.select(*by, "place").repartitionByRange(partitions(spark), *by)
    runs = arrow_map(
        ranged.sortWithinPartitions(*by, "place"), lambda batches: _runs(batches, min_documents), RUN
    )
    keys = runs.groupBy("h1", "h2").agg(F.sum("n_documents").alias("n"), F.min("first").alias("first"))
    keys = keys.where(F.col("n") >= min_documents)
    lost = occurrences.join(keys, ["h1", "h2"])
    if keep_first:
        at = F.struct("doc_id", "version", "place")
        lost = lost.where(~at.eqNullSafe(F.col("first")))
    per_document = lost.groupBy("doc_id", "version").agg(
        F.collect_set("place").alias("places"), F.max("n_lines").alias("n_lines")
    )
    return arrow_map(per_document, _bitmaps, BITMAP)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc, version, n_dropped, keep)``: every row of ``docs`` as a struct, beside its bitmap."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.withColumn("version", F.xxhash64(F.coalesce(F.col("doc.text"), F.lit(""))))
    found = bitmaps.select(F.col("doc_id").alias("b_id"), F.col("version").alias("b_version"), "n_dropped", "keep")
    same = F.col("doc.doc_id").eqNullSafe(F.col("b_id")) & (F.col("version") == F.col("b_version"))
    return rows.join(found, same, "left").select("doc", "n_dropped", "keep")


def kept_lines(text: bytes, keep: bytes | None) -> bytes:
    """The lines that a bitmap keeps, joined by newlines; all without a bitmap."""
    if keep is None:
        return text
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return b"\n".join(lines[i] for i in np.flatnonzero(bits))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals, digests = [], []
        keeps = batch.column("keep").to_pylist()
        for text, keep in zip(batch.column("text").cast(pa.large_binary()), keeps):
            text = text.as_py()
            totals.append(text.count(b"\n") + 1)
            digests.append(hashlib.sha256(kept_lines(text, keep)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(totals, pa.int64()), batch.column("n_dropped"), pa.array(digests)],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        keeps = batch.column("keep").to_pylist()
        for text, keep in zip(batch.column("text").cast(pa.large_binary()), keeps):
            texts.append(None if text.as_py() is None else kept_lines(text.as_py(), keep))
        cleaned = pa.array(texts, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), cleaned], ["doc", "text"])


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the lost lines taken out of ``text``, and ``n_chars``, if there, counted anew.

    A null text stays null; a text all of whose lines are lost becomes empty.
    """
    rows = with_bitmaps(docs, bitmaps)
    rest = [c for c in docs.columns if c != "text"]
    rows = rows.select(
        F.struct(*[F.col(f"doc.`{c}`") for c in rest]).alias("doc"), F.col("doc.text").alias("text"), "keep"
    )
    cleaned = arrow_map(rows, _cleaned, rows.drop("keep").schema)
    kept = {c: F.col(f"doc.`{c}`") for c in rest} | {"text": F.col("text")}
    if "n_chars" in kept:
        kind = docs.schema["n_chars"].dataType
        kept["n_chars"] = F.coalesce(F.length("text").cast(kind), kept["n_chars"])
    return cleaned.select(*[kept[c].alias(c) for c in docs.columns])


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more lost everywhere; digest of what is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = with_bitmaps(docs, line_bitmaps(docs, min_documents=10, min_chars=1))
    rows = rows.select(
        "doc.doc_id",
        F.coalesce("doc.text", F.lit("")).alias("text"),
        F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"),
        "keep",
    )
    return arrow_map(
        rows, _digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    )
