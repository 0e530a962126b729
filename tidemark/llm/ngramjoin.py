"""Similarity join of documents on word n-grams, as a blocked sparse matrix product.

Rows of the matrix are documents, columns their distinct n-grams. The linked pairs are the
entries of the product of the matrix with its transpose that reach a bound that follows
from the two sizes: overlap >= similarity / (1 + similarity) x (size + size).

Columns are cut into blocks, ranges of the n-grams' hash. Two documents whose sizes allow a
link differ in at most ``h`` n-grams, ``h`` following from the largest size of their class;
with ``h + 1`` blocks they agree in at least one whole block. So only pairs that agree in a
block are multiplied out: tasks exchange one hash per document and block instead of one
entry per n-gram. For those pairs the overlap is accumulated block by block, and a pair is
discarded as soon as what is left cannot reach the bound.

Documents that agree in a block are first paired with the least of them alone; all other
pairs are multiplied only where those links have not already joined them to one component.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.groups import whole_groups
from tidemark.llm.store import arrow_map, partitions, stored, table
from tidemark.llm.textblocks import blocks, lowered, mixed, shingle_hashes, word_hashes

DOCUMENT, BLOCKS, MEMBER = 0, 1, 2
ROW = "kind int, bucket int, doc long, n long, high long, low long, hashes binary, docs binary"
MET = "kind int, doc long, n long, high long, low long"
FLUSH = 1 << 19
RESEEDED = 24  # up to so many blocks an empty one is replaced by blocks of another hash
SEEDS = 8
MARKS = 512
PART = 512
BATCH = 2 << 20  # bytes of rows that come to a worker at a time
TEXT_BYTES = 1 << 19  # of texts hashed at a time; the arrays made of them take some 30 times as much


def size_class(size: int, percent: int) -> int:
    """Linked documents are of the same or of neighbouring classes."""
    return int(math.log(size) / math.log(100 / percent * 1.0001))


@functools.lru_cache(maxsize=4096)
def _edges(klass: int, percent: int) -> np.ndarray:
    """Lower hash bounds of the column blocks for documents of a class or the one below."""
    largest = math.floor((100 / percent * 1.0001) ** (klass + 1)) + 1
    differ = 2 * largest * (100 - percent) // (100 + percent)
    count = differ + 1
    return np.arange(count, dtype=np.uint64) * np.uint64((2**64 - 1) // count)


def block_hashes(grams: np.ndarray, percent: int) -> np.ndarray:
    """One hash per non-empty column block, for the document's class and the one above.

    ``grams`` are sorted and distinct. With few blocks an empty one is likely, and two
    documents could agree in nothing else; both then have hashes of further cuts as well.
    """
    found = []
    klass = size_class(len(grams), percent)
    for k in (klass, klass + 1):
        edges = _edges(k, percent)
        for seed in range(SEEDS):
            salt = np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % 2**64)
            columns = grams if seed == 0 else np.sort(mixed(grams ^ salt))
            bounds = np.append(np.searchsorted(columns, edges), len(columns))
            sums = np.append(np.uint64(0), np.cumsum(mixed(columns ^ salt)))
            filled = bounds[1:] > bounds[:-1]
            place = np.flatnonzero(filled)
            names = mixed((place + 1).astype(np.uint64) * np.uint64(k * SEEDS + seed + 1) + salt)
            found.append(mixed((sums[bounds[1:]] - sums[bounds[:-1]])[place] + names))
            if filled.all() or len(edges) > RESEEDED:
                break
    return np.concatenate(found)


def _grams(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each document of a block of texts."""
    words, bounds = word_hashes(lowered(data), offsets)
    runs = shingle_hashes(words, size) if len(words) >= size else words[:0]
    for first, last in zip(bounds[:-1], bounds[1:]):
        if last - first >= size:
            yield np.unique(runs[first : last - size + 1])
        else:
            yield np.unique(shingle_hashes(words[first:last], size))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    n = max(len(c) for c in columns.values())
    filled = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema
    ]
    return pa.RecordBatch.from_arrays(filled, schema=schema)


ROW_ARROW = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("doc", pa.int64()), ("n", pa.int64()),
     ("high", pa.int64()), ("low", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary())]
)
MET_ARROW = pa.schema([f for f in ROW_ARROW if f.name in ("kind", "doc", "n", "high", "low")])


def _incidence(batches: Iterator[pa.RecordBatch], size: int, percent: int, buckets: int):
    """Of each document its size and the hash of its set; of its blocks their hashes.

    Block hashes travel as sorted arrays, one row per task and bucket. Of the documents of
    one task that agree in a block only the least goes to the bucket; the others are
    reported at once, so a block of very many documents is no larger there than there are
    tasks. Of equal sets in one task only the first is cut into blocks.
    """
    seen: set[tuple[int, int]] = set()
    hashes: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    held = 0

    def flush():
        h = np.concatenate(hashes)
        d = np.concatenate(owners)
        hashes.clear(), owners.clear()
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        first = np.append(True, h[1:] != h[:-1])
        alone = first & np.append(first[1:], True)
        shared = np.flatnonzero(~alone)
        if len(shared):
            yield _batch(
                {"kind": np.full(len(shared), MEMBER), "bucket": (h[shared] % np.uint64(buckets)).astype(np.int32),
                 "doc": d[shared], "high": _signed(h[shared])}, ROW_ARROW,
            )
        h, d = h[first], d[first]
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        h, d, bucket = h[order], d[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        parts = [(b[0], x.tobytes(), y.tobytes()) for b, x, y in zip(*(np.split(v, cuts) for v in (bucket, h, d)))]
        if parts:
            names, x, y = zip(*parts)
            yield _batch({"kind": [BLOCKS] * len(x), "bucket": names, "hashes": x, "docs": y}, ROW_ARROW)

    for rows, data, offsets in blocks(batches, limit=TEXT_BYTES):
        ids = rows.column("doc_id").to_pylist()
        sizes, high, low = [], [], []
        for doc, grams in zip(ids, _grams(data, offsets, size)):
            n = len(grams)
            total = np.array([n], np.uint64)
            h = mixed(total + np.add.reduce(mixed(grams)))
            g = mixed(total * np.uint64(7) + np.add.reduce(mixed(~grams)))
            key = (int(_signed(h)[0]), int(_signed(g)[0]))
            sizes.append(n), high.append(key[0]), low.append(key[1])
            if n and doc is not None and key not in seen:
                seen.add(key)
                hashes.append(block_hashes(grams, percent))
                owners.append(np.full(len(hashes[-1]), doc, np.int64))
                held += len(hashes[-1])
        yield _batch(
            {"kind": [DOCUMENT] * len(ids), "bucket": [(i or 0) % buckets for i in ids], "doc": ids,
             "n": sizes, "high": high, "low": low}, ROW_ARROW,
        )
        if held >= FLUSH:
            yield from flush()
            held = 0
    if held:
        yield from flush()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass documents and members on; report the documents that agree in a block of a bucket."""
    hashes, owners = [], []
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        rest = batch.filter(pa.array(kind != BLOCKS))
        if rest.num_rows:
            yield rest.select(MET_ARROW.names)
        found = batch.filter(pa.array(kind == BLOCKS))
        for h, d in zip(found.column("hashes"), found.column("docs")):
            hashes.append(np.frombuffer(h.as_buffer(), np.uint64))
            owners.append(np.frombuffer(d.as_buffer(), np.int64))
    if not hashes:
        return
    h, d = np.concatenate(hashes), np.concatenate(owners)
    hashes.clear(), owners.clear()
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    same = h[1:] == h[:-1]
    shared = np.flatnonzero(np.append(same, False) | np.append(False, same))
    for start in range(0, len(shared), 1 << 16):
        part = shared[start : start + (1 << 16)]
        yield _batch({"kind": np.full(len(part), MEMBER), "doc": d[part], "high": _signed(h[part])}, MET_ARROW)


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, which is how they travel."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        packed = pa.array([pack.compress(t.as_py() or b"") for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed], ["doc", "packed"])


def _set(packed: bytes, size: int) -> np.ndarray:
    """The n-grams of a compressed text."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return next(_grams(data, np.array([0, len(data)]), size))


def marks(grams: np.ndarray) -> np.ndarray:
    """One byte for each of ``MARKS`` column blocks: where two documents' bytes differ, so do
    the blocks, by one n-gram at least."""
    edges = np.arange(MARKS, dtype=np.uint64) * np.uint64(2**64 // MARKS)
    bounds = np.append(np.searchsorted(grams, edges), len(grams))
    sums = np.append(np.uint64(0), np.cumsum(mixed(grams)))
    return (mixed(sums[bounds[1:]] - sums[bounds[:-1]]) >> np.uint64(56)).astype(np.uint8)


def _marked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, found = [], []
        for packed in batch.column("packed"):  # one text's n-grams at a time
            grams = _set(packed.as_py(), size)
            sizes.append(len(grams)), found.append(marks(grams).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"), batch.column("packed"), pa.array(sizes, pa.int64()),
                pa.array(found, pa.binary()),
            ],
            ["doc", "packed", "n", "marks"],
        )


def _across(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a block across components whose sizes and marks allow a link."""
    for rows, bounds in whole_groups(batches, ("block", "one", "other")):
        one, other, part, doc, component, n = (
            rows[c].to_numpy() for c in ("one", "other", "part", "doc", "component", "n")
        )
        all_marks = rows["marks"].to_pylist()
        found = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            here = np.frombuffer(b"".join(all_marks[a:b]), np.uint8).reshape(b - a, MARKS)
            d, c, k, p = doc[a:b], component[a:b], n[a:b], part[a:b]
            for i in range(b - a - 1):
                differ = (k[i] + k[i + 1 :]) * (100 - percent) // (100 + percent)
                open_ = (c[i] != c[i + 1 :]) & (np.abs(k[i] - k[i + 1 :]) <= differ)
                if one[a] != other[a]:
                    open_ &= p[i] != p[i + 1 :]
                at = np.flatnonzero(open_)
                at = at[(here[at + i + 1] != here[i]).sum(axis=1) <= differ[at]]
                if len(at):
                    there = d[at + i + 1]
                    found.append((np.minimum(d[i], there), np.maximum(d[i], there)))
        if found:
            columns = [np.concatenate(x) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b"])


def overlap(a: np.ndarray, b: np.ndarray, least: int, step: int = 512) -> int:
    """Common members of two sorted sets, or less than ``least`` once that cannot be reached.

    Accumulated over blocks of columns, with the members left after each as the bound.
    """
    total, i, j = 0, 0, 0
    while i < len(a) and j < len(b):
        if total + min(len(a) - i, len(b) - j) < least:
            return total
        edge = min(a[min(i + step, len(a)) - 1], b[min(j + step, len(b)) - 1])
        k, m = np.searchsorted(a, edge, side="right"), np.searchsorted(b, edge, side="right")
        total += len(np.intersect1d(a[i:k], b[j:m], assume_unique=True))
        i, j = k, m
    return total


def _products(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose overlap reaches the bound of their sizes."""
    known: tuple = (None, None)
    for batch in batches:
        linked = []
        for row in zip(*(batch.column(c) for c in ("a", "packed_a", "packed_b"))):
            name, x, y = (value.as_py() for value in row)
            if known[0] != (name, x):
                known = ((name, x), _set(x, size))
            a, b = known[1], _set(y, size)
            both = len(a) + len(b)
            least = -(-percent * both // (100 + percent))
            linked.append(min(len(a), len(b)) >= least and overlap(a, b, least) >= least)
        yield batch.filter(pa.array(linked, pa.bool_())).select(["a", "b"])


def _linked(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of documents that are similar."""
    a = texts.select(F.col("doc").alias("a"), F.col("packed").alias("packed_a"))
    b = texts.select(F.col("doc").alias("b"), F.col("packed").alias("packed_b"))
    met = pairs.join(b, "b").join(a, "a").select("a", "b", "packed_a", "packed_b")
    return stored(arrow_map(met, lambda x: _products(x, size, percent), "a long, b long").distinct(), "ngram-links", BATCH)


def ngram_join(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``.

    Words are runs of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; a document's set
    are its distinct runs of ``size`` words, or its whole sequence if shorter. Documents
    link when 100 x intersection >= ``percent`` x union; ``component_id`` is the least ``doc_id``
    that links reach. N-grams are compared by 64-bit hashes.

    A document without words or text has an empty set and links with nothing; a row without
    ``doc_id`` links with nothing and has no component. Rows with the same ``doc_id`` are one
    node with all their links. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    rows = arrow_map(
        docs.select("doc_id", F.col("text")), lambda b: _incidence(b, size, percent, buckets), ROW
    )
    met = stored(arrow_map(rows.repartition(buckets, "bucket"), _meet, MET), "ngram-blocks", BATCH)
    documents = met.where(F.col("kind") == DOCUMENT).select("doc", "n", "high", "low")
    named = documents.where("doc IS NOT NULL AND n > 0")
    # Dealt anew after the aggregate, so that the join reads a shuffle on either side: only then
    # does Spark split the rows of a set that very many documents have.
    least = named.groupBy("high", "low").agg(F.min("doc").alias("least")).repartition("least")
    equal = stored(named.join(least, ["high", "low"]).select("doc", "least").distinct(), "ngram-equal")

    # Equal sets are one row of the product, that of the least document.
    members = met.where(F.col("kind") == MEMBER).select("doc", F.col("high").alias("block"))
    members = members.join(equal, "doc").select("block", F.col("least").alias("doc")).distinct()
    members = stored(members, "ngram-members")
    centre = members.groupBy("block").agg(F.min("doc").alias("a"))
    tried = members.join(centre, "block").where("a < doc").select("a", F.col("doc").alias("b")).distinct()
    packed = arrow_map(docs.select("doc_id", F.col("text")), _squeezed, "doc long, packed binary")
    packed = packed.join(members.select("doc").distinct(), "doc", "left_semi")
    texts = stored(
        arrow_map(packed, lambda b: _marked(b, size), "doc long, packed binary, n long, marks binary"), "ngram-texts", BATCH
    )
    tried = stored(tried, "ngram-tried")
    links = _linked(tried, texts, size, percent)
    same = equal.where("doc != least").toDF("a", "b")
    joined = components(links.union(same))

    # Where a block's documents are still in several components, the pairs across them are
    # multiplied as well, if sizes and marks allow a link. A block of many documents is
    # split into parts, and its work into pairs of parts.
    placed = members.join(joined, members["doc"] == joined["node"], "left").select(
        "block", "doc", F.coalesce("component", "doc").alias("component")
    )
    open_blocks = placed.groupBy("block").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("docs")
    ).where("least != most AND docs > 2")
    parts = F.ceil(F.col("docs") / PART).cast("int")
    left = placed.join(open_blocks.select("block", parts.alias("parts")), "block")
    part = F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")
    left = left.select(
        "block", "doc", "component", part.alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with"),
    )
    left = left.select(
        "block", "doc", "component", "part",
        F.least("part", "with").alias("one"), F.greatest("part", "with").alias("other"),
    )
    work = left.join(texts.select("doc", "n", "marks"), "doc").repartition(buckets, "block", "one", "other")
    work = work.sortWithinPartitions("block", "one", "other")
    more = arrow_map(work, lambda b: _across(b, percent), "a long, b long").distinct()
    more = stored(more.join(tried, ["a", "b"], "left_anti"), "ngram-across", BATCH)
    found = _linked(more, texts, size, percent)
    if not found.isEmpty():
        joined = components(links.union(same).union(found))
    return documents.join(joined, documents["doc"] == joined["node"], "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, *, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is the least of its component in ``ngram_join``.

    Of rows with the same ``doc_id`` and text one stays, the first by its other columns as JSON. Rows
    without ``doc_id`` all stay. Columns may have any names; an empty table stays empty.
    """
    joined = ngram_join(docs, size=size, percent=percent)
    kept = joined.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct()
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("of_id"),
        F.xxhash64("text").alias("of_text"),
        F.to_json(F.struct(*others)).alias("place"),
    )
    # Dealt by id alone and sorted within, so that texts are shuffled and sorted once for window and join.
    named = rows.where("of_id IS NOT NULL").repartition("of_id")
    order = Window.partitionBy("of_id", "of_text").orderBy("place")
    first = named.withColumn("number", F.row_number().over(order)).where("number = 1")
    first = first.join(kept, F.col("of_id") == F.col("kept_id"), "left_semi").select("row")
    unnamed = rows.where("of_id IS NULL").select("row")
    return first.union(unnamed).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op3_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Documents linked at 90 % of their three-word shingles."""
    return ngram_join(table(spark, sf_dir, "documents"), size=3, percent=90)
