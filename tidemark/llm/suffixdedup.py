"""Removal of byte strings that an earlier document has, by suffix arrays of candidate texts.

A document loses each byte covered by a string of ``length`` bytes that also starts in a
document with a smaller id. Text that can be concerned is found first: of the ``length - GRAM +
1`` byte n-grams in a string the one with the least hash is its anchor, so equal strings have
equal anchors, and the strings of one anchor in a row form one context of a few dozen bytes.
Tasks exchange anchor hashes; a context whose anchor no other document has goes no further.

The others meet by anchor. Equal contexts are reduced to the earliest document's, before
they are exchanged and again where they meet; different ones to what each has in common
with any other around the anchor. Where several such parts remain, they are joined, and the suffix array of the joined text (``suffixes``) brings equal
strings of ``length`` bytes next to each other, whatever contexts they are in.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import arrow_map, partitions, stored, table
from tidemark.llm.suffixes import suffix_array
from tidemark.llm.textblocks import BYTE_CODES, MULTIPLIER, blocks, mixed

LENGTH = 50
GRAM = 18
STRETCH = 1 << 20  # strings whose anchors are sought at a time
FLUSH = 1 << 20
SUFFIX_TEXT = 1 << 18  # joined text of one suffix array
LARGE = 1 << 20  # an anchor with more text is sorted string by string

ANCHORS, ANSWER, HEADER = 0, 1, 2
SENT = "kind int, bucket int, chunk string, docs binary, hashes binary, owners binary, ordinals binary"
ANSWERED = "kind int, chunk string, docs binary, owners binary, ordinals binary"
CONTEXTS, REMOVED = 3, 4
MEETING = "kind int, bucket int, doc_id long, version long, start long, mask long, contexts binary"
FOUND = "doc_id long, version long, start long, mask long"


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every position on that has so many."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    power = BYTE_CODES[data]  # hash of the 2^k bytes from each position on
    factor, done, width = int(MULTIPLIER), 0, 1
    while True:
        if size & width:
            total = total * np.uint64(factor) + power[done : done + n]
            done += width
        if done == size:
            return mixed(total)
        power = power[:-width] * np.uint64(factor) + power[width:]
        factor = factor * factor % 2**64
        width *= 2


def contexts(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``(owner, start, strings, hash, ahead)``: runs of strings with one anchor, by position.

    A run has ``strings`` strings of ``length`` bytes, the first from ``start`` on, ``ahead`` bytes
    before the anchor; none reaches over the end of a document.
    """
    reach = length - gram + 1
    found: list[list] = []
    last = None  # owner and anchor of the last run
    for first in range(0, max(len(data) - length + 1, 0), STRETCH):
        part = data[first : first + STRETCH + length - 1]
        hashes = gram_hashes(part, gram)
        # The hash's leading bits and the position in one number: the least is the leftmost of equals.
        least = (hashes & ~np.uint64(STRETCH * 2 - 1)) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while width * 2 <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if reach > width:
            rest = reach - width
            least = np.minimum(least[:-rest], least[rest:])
        anchor = (least & np.uint64(STRETCH * 2 - 1)).astype(np.int64)
        start = np.arange(len(anchor)) + first
        owner = np.searchsorted(offsets, start, side="right") - 1
        inside = start + length <= offsets[owner + 1]
        start, owner, anchor = start[inside], owner[inside], anchor[inside]
        if not len(start):
            continue
        new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
        strings = np.diff(np.append(new, len(start)))
        runs = [owner[new], start[new], strings, hashes[anchor[new]], anchor[new] + first - start[new]]
        if last == (int(owner[0]), int(anchor[0]) + first):  # goes on from the stretch before
            found[-1][2][-1] += strings[0]
            runs = [x[1:] for x in runs]
        last = (int(owner[-1]), int(anchor[-1]) + first)
        if len(runs[0]):
            found.append(runs)
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, np.uint64), empty
    return tuple(np.concatenate(x) for x in zip(*found))


def _rows(schema: str, **columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [pa.field(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in fields]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))


def _anchors(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """Send each anchor hash of a chunk of documents once to its bucket.

    If several documents of a chunk have it, all but the first are answered at once: it is
    shared whatever other chunks have. ``ordinals`` number a document's contexts.
    """
    held: list[tuple] = []
    docs: list[tuple[int, int]] = []
    count = 0

    def flush():
        owner, ordinal, h = (np.concatenate(x) for x in zip(*held))
        names = np.array(docs, np.int64).reshape(-1, 2)
        chunk = hashlib.md5(names.tobytes()).hexdigest()
        home = int(chunk[:8], 16) % buckets
        yield _rows(SENT, kind=[HEADER], bucket=[home], chunk=[chunk], docs=[names.tobytes()])
        held.clear(), docs.clear()
        if not len(h):
            return
        order = np.lexsort((ordinal, owner, h))
        owner, ordinal, h = owner[order], ordinal[order], h[order]
        first = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))
        owner, ordinal, h = owner[first], ordinal[first], h[first]
        new = np.append(True, h[1:] != h[:-1])
        several = ~new | ~np.append(new[1:], True)
        yield _rows(
            SENT, kind=[ANSWER], bucket=[home], chunk=[chunk],
            owners=[owner[several].astype(np.uint32).tobytes()], ordinals=[ordinal[several].astype(np.uint32).tobytes()],
        )
        owner, ordinal, h = owner[new], ordinal[new], h[new]
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.flatnonzero(np.diff(bucket[order])) + 1
        columns = {
            "hashes": np.split(h[order], cut),
            "owners": np.split(owner[order].astype(np.uint32), cut),
            "ordinals": np.split(ordinal[order].astype(np.uint32), cut),
        }
        names = bucket[order][np.append(0, cut)]
        yield _rows(
            SENT, kind=[ANCHORS] * len(names), bucket=names, chunk=[chunk] * len(names),
            **{k: [x.tobytes() for x in v] for k, v in columns.items()},
        )

    for rows, data, offsets in blocks(batches):
        owner, _, _, h, _ = contexts(data, offsets, length)
        ordinal = np.arange(len(owner)) - np.searchsorted(owner, owner)
        held.append((owner + len(docs), ordinal, h))
        docs += zip(rows.column("doc_id").to_pylist(), rows.column("version").to_pylist())
        count += len(owner)
        if count >= FLUSH:
            yield from flush()
            count = 0
    if docs:
        yield from flush()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answer the chunks whose anchors other chunks have as well."""
    chunks, hashes, owners, ordinals = [], [], [], []
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        rest = batch.filter(pa.array(kind != ANCHORS))
        if rest.num_rows:
            yield rest.select(["kind", "chunk", "docs", "owners", "ordinals"])
        for row in batch.filter(pa.array(kind == ANCHORS)).to_pylist():
            chunks.append(row["chunk"])
            hashes.append(np.frombuffer(row["hashes"], np.uint64))
            owners.append(np.frombuffer(row["owners"], np.uint32))
            ordinals.append(np.frombuffer(row["ordinals"], np.uint32))
    if not chunks:
        return
    h = np.concatenate(hashes)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    shared = np.zeros(len(h), dtype=bool)
    shared[order] = np.append(same, False) | np.append(False, same)
    edges = np.append(0, np.cumsum([len(x) for x in hashes]))
    for k, chunk in enumerate(chunks):
        part = shared[edges[k] : edges[k + 1]]
        if part.any():
            yield _rows(
                ANSWERED, kind=[ANSWER], chunk=[chunk],
                owners=[owners[k][part].tobytes()], ordinals=[ordinals[k][part].tobytes()],
            )


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shared contexts of each document, from the answers to its chunk."""
    heads, answers = {}, defaultdict(list)
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == HEADER:
                heads[row["chunk"]] = np.frombuffer(row["docs"], np.int64).reshape(-1, 2)
            else:
                answers[row["chunk"]].append([np.frombuffer(row[k], np.uint32) for k in ("owners", "ordinals")])
    for chunk, parts in answers.items():
        owner, ordinal = (np.concatenate(x) for x in zip(*parts))
        if not len(owner):
            continue
        order = np.argsort(owner, kind="stable")
        owner, ordinal = owner[order], ordinal[order]
        cut = np.flatnonzero(np.diff(owner)) + 1
        docs = heads[chunk][owner[np.append(0, cut)]]
        yield _rows(
            "doc_id long, version long, ordinals binary", doc_id=docs[:, 0], version=docs[:, 1],
            ordinals=[x.tobytes() for x in np.split(ordinal, cut)],
        )


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes: they are exchanged twice."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = [pack.compress(t.as_py() or b"") for t in batch.column("text").cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("version"), pa.array(packed, pa.binary())],
            ["doc_id", "version", "packed"],
        )


def whole(context: bytes, length: int) -> int:
    """The mask of all strings of a context."""
    return (1 << (len(context) - length + 1)) - 1


def _candidates(batches: Iterator[pa.RecordBatch], buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    """Send the shared contexts of documents to the buckets of their anchors.

    Of equal contexts in one task those of the least document go on; the others are removed.
    """
    unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
    held: dict[bytes, tuple] = {}
    size = 0

    def flush():
        outgoing = defaultdict(list)
        removed = []
        for text, (h, ahead, entries) in held.items():
            least = min(e[0] for e in entries)
            for doc, version, start in entries:
                if doc > least:
                    removed.append((doc, version, start, whole(text, length)))
                else:
                    outgoing[h % buckets].append((h, doc, version, start, ahead, text))
        held.clear()
        if removed:
            docs, versions, starts, masks = zip(*removed)
            yield _rows(
                MEETING, kind=[REMOVED] * len(docs), bucket=[d % buckets for d in docs], doc_id=docs,
                version=versions, start=starts, mask=masks,
            )
        packed = []
        for entries in outgoing.values():
            entries.sort()
            numbers = np.array([(h - (1 << 63), *e, len(t)) for h, *e, t in entries], np.int64)
            body = numbers.T.tobytes() + b"".join(e[-1] for e in entries)
            packed.append(pack.compress(np.int64(len(entries)).tobytes() + body))
        if packed:
            yield _rows(MEETING, kind=[CONTEXTS] * len(packed), bucket=list(outgoing), contexts=packed)

    for batch in batches:
        for doc, version, packed, ordinals in zip(
            *(batch.column(c).to_pylist() for c in ("doc_id", "version", "packed", "ordinals"))
        ):
            text = unpack.decompress(packed)
            data = np.frombuffer(text, np.uint8)
            _, start, strings, h, ahead = contexts(data, np.array([0, len(data)]), length)
            chosen = np.isin(h, h[np.frombuffer(ordinals, np.uint32)])
            ends = start + strings + length - 1
            for name, a, b, at in zip(*(x[chosen].tolist() for x in (h, start, ends, ahead))):
                part = text[a:b]
                known = held.get(part)
                if known is None:
                    held[part] = (name, at, [(doc, version, a)])
                else:
                    known[2].append((doc, version, a))
                size += 1
            if size >= FLUSH // 4:
                yield from flush()
                size = 0
    if held:
        yield from flush()


def repeated_strings(texts: list[bytes], docs: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Per text a bit mask of its strings (first start: lowest bit) that a smaller document has.

    All strings of ``length`` bytes are compared through one suffix array of the joined texts.
    """
    sizes = np.array([len(t) for t in texts])
    joined = np.frombuffer(b"".join(t + b"\x00" for t in texts), np.uint8)
    symbols = joined.astype(np.int64) + 1
    ends = np.cumsum(sizes + 1) - 1
    symbols[ends] = 0
    order = suffix_array(symbols)
    which = np.searchsorted(ends, order, side="left")
    first = ends - sizes
    usable = order + length <= ends[which]
    order, which = order[usable], which[usable]
    rows = joined[order[:, None] + np.arange(length)]
    same = np.append(False, (rows[1:] == rows[:-1]).all(axis=1))
    return _masks(order - first[which], which, same, docs, len(texts))


def _masks(place: np.ndarray, which: np.ndarray, same: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    """Masks from strings in an order that puts equal ones side by side."""
    masks = np.zeros(n, np.int64)
    if not len(place):
        return masks
    begins = np.flatnonzero(~same)
    least = np.minimum.reduceat(docs[which], begins)
    later = docs[which] > np.repeat(least, np.diff(np.append(begins, len(place))))
    np.bitwise_or.at(masks, which[later], np.int64(1) << place[later])
    return masks


def _by_strings(
    texts: list[bytes], docs: np.ndarray, anchors: np.ndarray, length: int, gram: int
) -> np.ndarray:
    """The same masks for very many contexts of one anchor, one place before the anchor at a time."""
    masks = np.zeros(len(texts), np.int64)
    sizes = np.array([len(t) for t in texts])
    joined = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum(sizes) - sizes
    for ahead in range(length - gram + 1):
        place = anchors - ahead
        which = np.flatnonzero((place >= 0) & (place + length <= sizes))
        if not len(which):
            continue
        rows = joined[(first[which] + place[which])[:, None] + np.arange(length)]
        names = np.ascontiguousarray(rows).view(f"V{length}").ravel()
        order = np.argsort(names, kind="stable")
        same = np.append(False, names[order][1:] == names[order][:-1])
        masks |= _masks(place[which][order], which[order], same, docs, len(texts))
    return masks


def most_shared(parts: list[bytes]) -> list[int]:
    """How many leading bytes each part has in common with any other, at most."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    most = [0] * len(parts)
    for i, j in zip(order, order[1:]):
        a, b = parts[i], parts[j]
        n = min(len(a), len(b))
        differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
        common = n - (differ.bit_length() + 7) // 8
        most[i], most[j] = max(most[i], common), max(most[j], common)
    return most


def shared_parts(kept: list[tuple], length: int, gram: int) -> tuple[list[tuple], list[tuple]]:
    """What different contexts of an anchor have in common, and the strings that go for that.

    ``kept`` are ``(context, ahead, entries)``. A string that two contexts share lies between the
    most bytes before and after the anchor that a context shares with any other. Of equal
    parts those of later documents go; one of each is left, with its earliest entries.
    """
    before = most_shared([text[:ahead][::-1] for text, ahead, _ in kept])
    after = most_shared([text[ahead + gram :] for text, ahead, _ in kept])
    equal = defaultdict(list)
    for (text, ahead, entries), x, y in zip(kept, before, after):
        if x + gram + y >= length:
            cut = ahead - x
            part = text[cut : ahead + gram + y]
            equal[part, x].extend((doc, version, start + cut) for doc, version, start in entries)
    left, gone = [], []
    for (part, ahead), entries in equal.items():
        least = min(e[0] for e in entries)
        gone.extend((*e, whole(part, length)) for e in entries if e[0] > least)
        left.append((part, ahead, [e for e in entries if e[0] == least]))
    return left, gone


def _met(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Compare the contexts of each anchor of a task's buckets."""
    unpack = zstandard.ZstdDecompressor()
    groups: dict[int, dict[bytes, list]] = defaultdict(dict)
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        rest = batch.filter(pa.array(kind == REMOVED))
        if rest.num_rows:
            yield rest.select(["doc_id", "version", "start", "mask"])
        for packed in batch.filter(pa.array(kind == CONTEXTS)).column("contexts").to_pylist():
            raw = unpack.decompress(packed)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            numbers = np.frombuffer(raw, np.int64, 6 * n, 8).reshape(6, n).tolist()
            at = 8 + 48 * n
            for h, doc, version, start, ahead, size in zip(*numbers):
                known = groups[h].setdefault(raw[at : at + size], (ahead, []))
                known[1].append((doc, version, start))
                at += size

    found: list[tuple[int, int, int, int]] = []
    waiting: list[tuple[bytes, int, list]] = []  # texts, and the entries of their least document
    size = 0

    def compared(texts, large=False):
        joined, ahead, entries = zip(*texts)
        docs = np.array([e[0][0] for e in entries], np.int64)
        if large:
            masks = _by_strings(joined, docs, np.array(ahead), length, gram)
        else:
            masks = repeated_strings(joined, docs, length)
        for mask, own in zip(masks.tolist(), entries):
            if mask:
                found.extend((*e, mask) for e in own)

    for group in groups.values():
        kept = []
        for text, (ahead, entries) in group.items():
            least = min(e[0] for e in entries)
            found.extend((*e, whole(text, length)) for e in entries if e[0] > least)
            kept.append((text, ahead, [e for e in entries if e[0] == least]))
        if len(kept) > 1:
            kept, gone = shared_parts(kept, length, gram)
            found.extend(gone)
        if len(kept) > 1:
            total = sum(len(t) for t, _, _ in kept)
            if total > LARGE:
                compared(kept, large=True)
            else:
                waiting += kept
                size += total
        if size >= SUFFIX_TEXT:
            compared(waiting)
            waiting, size = [], 0
        if len(found) >= 1 << 17:
            yield _rows(FOUND, **dict(zip(("doc_id", "version", "start", "mask"), zip(*found))))
            found.clear()
    if waiting:
        compared(waiting)
    if found:
        yield _rows(FOUND, **dict(zip(("doc_id", "version", "start", "mask"), zip(*found))))


def removed_spans(starts: np.ndarray, masks: np.ndarray, size: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """The maximal runs ``[a, b)`` of bytes covered by the strings that the masks name."""
    bits = np.arange(length)
    picked = (masks[:, None] >> bits) & 1
    at = (starts[:, None] + bits)[picked == 1]
    at = np.unique(at[at + length <= size])
    if not len(at):
        return []
    begins = np.flatnonzero(np.append(True, at[1:] > at[:-1] + length))
    ends = np.append(at[begins[1:] - 1], at[-1]) + length
    return list(zip(at[begins].tolist(), ends.tolist()))


def _remaining(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        sizes, removed, spans, digests, cuts = [], [], [], [], []
        starts, masks = batch.column("starts"), batch.column("masks")
        copies = batch.column("copy").to_pylist()
        for i, packed in enumerate(batch.column("packed").to_pylist()):
            text = unpack.decompress(packed)
            if copies[i]:
                runs = [(0, len(text))] if len(text) >= length else []
            elif starts[i].is_valid and len(starts[i].values):
                runs = removed_spans(starts[i].values.to_numpy(), masks[i].values.to_numpy(), len(text), length)
            else:
                runs = []
            edges = [0, *(x for run in runs for x in run), len(text)]
            rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            sizes.append(len(text))
            removed.append(len(text) - len(rest))
            spans.append(len(runs))
            digests.append(hashlib.sha256(rest).hexdigest())
            cuts.append([{"first": a, "last": b} for a, b in runs])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()), pa.array(digests, pa.string()),
                pa.array(cuts, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


RESULT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "spans array<struct<first: long, last: long>>"
)


def suffix_dedup(docs: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` for every row of ``docs``.

    Texts are UTF-8 bytes; ``spans`` are the byte ranges removed. Strings are judged on the
    input, overlap freely and never cross documents. ``length`` is at most 62 + ``GRAM``.

    Null text is empty. A text shorter than ``length`` loses nothing. A row without ``doc_id`` has
    no place in the order: it loses nothing and takes nothing. Rows with the same ``doc_id`` take
    nothing from each other. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("version"), text.alias("text"))
    named = rows.where("doc_id IS NOT NULL")

    # A text that a smaller document has as a whole needs no comparison of strings.
    names = stored(
        named.select("doc_id", "version", F.xxhash64(F.lit(length), "text").alias("second")), "suffix-names"
    )
    # Dealt anew after the aggregate, so that the join reads a shuffle on either side: only then
    # does Spark split the rows of a text that very many documents have.
    least = names.groupBy("version", "second").agg(F.min("doc_id").alias("least")).repartition("least")
    placed = names.join(least, ["version", "second"]).select("doc_id", "version", (F.col("doc_id") > F.col("least")).alias("copy"))
    placed = stored(placed.distinct(), "suffix-copies")

    sent = arrow_map(named, lambda b: _anchors(b, buckets, length), SENT).repartition(buckets, "bucket")
    answered = stored(arrow_map(sent, _shared, ANSWERED), "suffix-anchors")
    shared = arrow_map(
        answered.repartition(buckets, "chunk"), _by_document, "doc_id long, version long, ordinals binary"
    )
    originals = placed.where("NOT copy").select("doc_id", "version")
    shared = shared.dropDuplicates(["doc_id", "version"]).join(originals, ["doc_id", "version"], "left_semi")

    packed = arrow_map(rows, _squeezed, "doc_id long, version long, packed binary")
    unique = packed.where("doc_id IS NOT NULL").join(shared, ["doc_id", "version"])
    meeting = arrow_map(unique, lambda b: _candidates(b, buckets, length), MEETING)
    found = arrow_map(meeting.repartition(buckets, "bucket"), lambda b: _met(b, length, GRAM), FOUND)
    found = stored(found, "suffix-strings")

    per_document = found.groupBy("doc_id", "version").agg(
        F.collect_list("start").alias("starts"), F.collect_list("mask").alias("masks")
    )
    copies = placed.where("copy")
    known = per_document.join(copies, ["doc_id", "version"], "full")
    all_rows = packed.toDF("id", "of", "packed").join(
        known, (F.col("id") == F.col("doc_id")) & (F.col("of") == F.col("version")), "left"
    )
    all_rows = all_rows.select(F.col("id").alias("doc_id"), "packed", "starts", "masks", F.coalesce("copy", F.lit(False)).alias("copy"))
    return arrow_map(all_rows, lambda b: _remaining(b, length), RESULT)


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """What every document loses to smaller ones, at 50 bytes."""
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("spans")
