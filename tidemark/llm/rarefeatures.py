"""Document fingerprints from improbable features.

Every window of 32 bytes has an entropy, and a histogram over all windows of all documents tells
how rare each class of entropy is. In every run of 32 neighbouring windows the rarest (the
first of equals) gets a point, and windows with enough points are a text's features. These are
hashed into a chain of Bloom filters, a new one for every 128, which is the fingerprint. Two
fingerprints are compared by the overlap of their filters' bits, normalised between the overlap
that chance gives and the largest possible.

For edited texts a document has to meet its successor in the order of ``doc_id``. Documents are
dealt to ranges of that order, and the first of each range goes to the range before as well, as
a guest: every task has what it needs in one pass, and no text is shuffled twice.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import arrow_map, partitions, table
from tidemark.llm.textblocks import MULTIPLIER, blocks, mixed

WINDOW = 32
RUN = 32
POINTS = 8
CLASSES = 1000
LEAST_CLASS = 100  # windows below this entropy (a run of few different bytes) say nothing
FILTER_BYTES = 256
FILTER_BITS = 8 * FILTER_BYTES
CAPACITY = 128
HASHES = 5
CUT = 0.3
BLOCK = 1 << 19
STEP = 1 << 17  # bytes whose windows are ranked at a time
ONE = 1 << 20  # whole units in a bit of entropy
LAST = 0x7FFFFFFF  # rank of what is no window


def _gains() -> np.ndarray:
    """How much n log2 n grows from n to n + 1, in whole units."""
    n = np.arange(WINDOW + 1, dtype=np.float64)
    total = np.zeros(WINDOW + 1)
    total[1:] = n[1:] * np.log2(n[1:])
    return np.diff(np.rint(total * ONE).astype(np.int64))


GAINS = _gains()


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The entropy of the window that starts at each byte, from 0 to ``CLASSES``.

    A window slides by one byte in and one out; how often the byte is in the window tells the
    change. Whole units make the result the same wherever a block begins.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int16)
    before = np.zeros(n, np.uint8)
    after = np.zeros(n, np.uint8)
    for shift in range(1, WINDOW):
        same = (data[shift:] == data[:-shift]).view(np.uint8)
        before[shift:] += same
        after[:-shift] += same
    total = np.cumsum(GAINS[before])
    total[WINDOW:] -= np.cumsum(GAINS[after[:-WINDOW]])
    bits = int(np.log2(WINDOW))
    entropy = bits * WINDOW * ONE - total[WINDOW - 1 :]
    return (entropy * CLASSES // (bits * WINDOW * ONE)).astype(np.int16)


def whole_windows(offsets: np.ndarray, size: int) -> np.ndarray:
    """Which windows, by their first byte, lie within one text."""
    inside = np.ones(size, dtype=bool)
    for edge in offsets[1:].tolist():
        inside[max(edge - WINDOW + 1, 0) : edge] = False
    return inside


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(CLASSES + 1, np.int64)
    for _, data, offsets in blocks(batches, limit=BLOCK):
        inside = whole_windows(offsets, len(data))
        for begin in range(0, len(data), STEP):
            found = entropy_classes(data[begin : begin + STEP + WINDOW - 1])
            counts += np.bincount(found[inside[begin : begin + len(found)]], minlength=CLASSES + 1)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["class", "n"])


def entropy_histogram(docs: DataFrame) -> DataFrame:
    """``(class, n)``: windows of all whole texts by their entropy, at most ``CLASSES`` + 1 rows.

    Null and empty texts and those shorter than a window have none.
    """
    counted = arrow_map(docs.select("text"), _histogram, "class int, n long")
    return counted.groupBy("class").agg(F.sum("n").alias("n"))


def rarity_ranks(histogram: DataFrame) -> np.ndarray:
    """The rank of every class, rarest first, equals by class; unseen classes come first."""
    counts = np.zeros(CLASSES + 1, np.int64)
    for row in histogram.collect():  # bounded: one row per class
        counts[row["class"]] = row["n"]
    ranks = np.empty(CLASSES + 1, np.int64)
    ranks[np.lexsort((np.arange(CLASSES + 1), counts))] = np.arange(CLASSES + 1)
    ranks[:LEAST_CLASS] = CLASSES + 1
    return ranks


def window_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows that start at ``places``."""
    windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places]
    words = np.ascontiguousarray(windows).view("<u8")
    total = np.zeros(len(places), np.uint64)
    for i in range(words.shape[1]):
        total = mixed(total * MULTIPLIER + words[:, i] + np.uint64(i + 1))
    return total


def window_points(data: np.ndarray, inside: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """One more than the runs of ``RUN`` windows in which each window is the rarest.

    Zero where a window crosses texts or has too little entropy.
    """
    points = np.zeros(len(data), np.uint8)
    for begin in range(0, len(data), STEP):
        first = max(begin - RUN + 1, 0)
        classes = entropy_classes(data[first : begin + STEP + RUN + WINDOW - 2])
        if not len(classes):
            break
        rank = np.where(inside[first : first + len(classes)], ranks[classes], LAST)
        ahead = np.append(rank, np.full(RUN, LAST, np.int64)) << 32 | np.arange(len(rank) + RUN)
        width = 1
        while width < RUN:  # the least of 2, 4, ... windows from each place on
            ahead = np.minimum(ahead[:-width], ahead[width:])
            width *= 2
        winners = ahead[: len(rank)][rank < LAST] & 0xFFFFFFFF
        found = np.bincount(winners, minlength=len(rank)) + 1
        found[rank > CLASSES] = 0
        own = found[begin - first : begin - first + STEP]
        points[begin : begin + len(own)] = own
    return points


def features(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature hashes of every text in order of place, and their bounds by text.

    ``POINTS`` make a window a feature; in a text with no more windows than a filter takes, every window
    is one. A text without a window of enough entropy is one feature itself, an empty one has none.
    """
    texts = len(offsets) - 1
    owner, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) >= WINDOW:
        points = window_points(data, whole_windows(offsets, len(data)), ranks)
        lengths = np.diff(offsets)
        enough = np.where(lengths - WINDOW < CAPACITY, 1, POINTS + 1).astype(np.uint8)
        places = np.flatnonzero(points >= np.repeat(enough, lengths))
        owner = np.searchsorted(offsets, places, side="right") - 1
        hashes = window_hashes(data, places)
    left = np.setdiff1d(np.flatnonzero(np.diff(offsets)), owner)
    if len(left):
        alone = [hashlib.sha256(data[offsets[t] : offsets[t + 1]]).digest()[:8] for t in left.tolist()]
        owner = np.append(owner, left)
        hashes = np.append(hashes, np.frombuffer(b"".join(alone), "<u8"))
    order = np.lexsort((np.arange(len(owner)), hashes, owner))
    again = np.zeros(len(order), dtype=bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    kept = np.ones(len(order), dtype=bool)
    kept[order[again]] = False
    owner, hashes = owner[kept], hashes[kept]
    by_text = np.argsort(owner, kind="stable")
    return hashes[by_text], np.searchsorted(owner[by_text], np.arange(texts + 1))


def filters(hashes: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters of a text's features, a row of packed bits for each."""
    chain = np.zeros((-(-len(hashes) // CAPACITY), FILTER_BITS), dtype=bool)
    at = np.arange(len(hashes)) // CAPACITY
    for number in range(HASHES):
        bit = hashes >> np.uint64(11 * number) & np.uint64(FILTER_BITS - 1)
        chain[at, bit.astype(np.int64)] = True
    return np.packbits(chain, axis=1)


def encoded(chain: np.ndarray) -> str:
    """A fingerprint as text: the number of filters and their bits."""
    return f"{len(chain)}:{base64.b64encode(chain.tobytes()).decode()}"


def decoded(fingerprint: str) -> np.ndarray:
    bits = base64.b64decode(fingerprint.partition(":")[2])
    return np.frombuffer(bits, np.uint8).reshape(-1, FILTER_BYTES)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """From 0 to 1 how alike two chains are: 1 where equal, 0 if one is empty.

    Each filter of the shorter chain meets the filter of the other it overlaps most, and the
    scores are averaged by their bits.
    """
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if (len(b), b.tobytes()) < (len(a), a.tobytes()):  # the same both ways round
        a, b = b, a
    other = np.unpackbits(b, axis=1).astype(np.float32)
    sizes = other.sum(axis=1)
    score = weight = 0.0
    for start in range(0, len(a), 512):
        own = np.unpackbits(a[start : start + 512], axis=1).astype(np.float32)
        n = own.sum(axis=1)
        chance = n[:, None] * sizes / FILTER_BITS
        most = np.minimum(n[:, None], sizes)
        floor = chance + CUT * (most - chance)
        over = np.maximum(own @ other.T - floor, 0) / np.maximum(most - floor, 1e-6)
        score += float((np.minimum(over.max(axis=1), 1.0) * n).sum(dtype=np.float64))
        weight += float(n.sum(dtype=np.float64))
    return score / weight


def _chains(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    offsets = np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64))
    hashes, bounds = features(np.frombuffer(b"".join(texts), np.uint8), offsets, ranks)
    return [filters(hashes[i:j]) for i, j in zip(bounds[:-1], bounds[1:])]


def _fingerprinted(batches: Iterator[pa.RecordBatch], ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in blocks(batches, limit=BLOCK):
        hashes, bounds = features(data, offsets, ranks)
        prints = [encoded(filters(hashes[i:j])) for i, j in zip(bounds[:-1], bounds[1:])]
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(prints)], ["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row.

    ``ranks`` are those of ``rarity_ranks``, by default over ``docs`` itself; fingerprints can only be
    compared if they share them. Null text counts as empty, whose fingerprint has no filter. Equal
    texts have equal fingerprints. Repeated rows and rows without ``doc_id`` are each fingerprinted,
    other columns are ignored, and an empty table gives no rows.
    """
    known = rarity_ranks(entropy_histogram(docs)) if ranks is None else ranks
    rows = docs.select("doc_id", "text")
    return arrow_map(rows, lambda b: _fingerprinted(b, known), "doc_id long, fingerprint string")


# --- documents beside their successors ---------------------------------------------------

KEY = "place long, tie long, doc_id long, text string"


def _keyed(docs: DataFrame) -> DataFrame:
    """``place`` orders rows by ``doc_id``, null first; ``tie`` orders the texts of an id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    return docs.select(place.alias("place"), F.xxhash64(text).alias("tie"), "doc_id", text.alias("text"))


def _range_starts(keyed: DataFrame, ranges: int) -> list[tuple[int, int]]:
    """The first ``(place, tie)`` of each of some ranges with about as many rows; narrow."""
    ranged = keyed.select("place", "tie").repartitionByRange(ranges, "place", "tie")
    firsts = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("place", "tie")).alias("f"))
    return sorted((row.f.place, row.f.tie) for row in firsts.collect())  # bounded by ``ranges``


def _dealt(batches: Iterator[pa.RecordBatch], starts: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Rows with their range and number of copies; firsts of ranges also as guests of the one before.

    Equal rows of a batch become one, so that very many copies are few rows of the shuffle.
    """
    known = set(starts)
    for batch in batches:
        copies: dict = {}
        first = []
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("place", "tie", "doc_id"))))
        for i, key in enumerate(keys):
            if key not in copies:
                first.append(i)
            copies[key] = copies.get(key, 0) + 1
        rows, ranges, guests = [], [], []
        for i in first:
            at = keys[i][:2]
            number = bisect_right(starts, at) - 1
            rows.append(i)
            ranges.append(number)
            guests.append(False)
            if at in known:
                rows.append(i)
                ranges.append((number - 1) % len(starts))
                guests.append(True)
        taken = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ranges, pa.int32()), pa.array(guests, pa.bool_())]
            + [pa.array([copies[keys[i]] for i in rows], pa.int64()), *taken.columns],
            ["range", "guest", "copies", "place", "tie", "doc_id", "text"],
        )


def beside_next(docs: DataFrame, function, schema: str) -> DataFrame:
    """``function`` over groups of documents and the text after each, in the order of ``doc_id``.

    It takes lists of ids, copies, texts and following texts (as bytes) and returns a record batch. Rows
    equal in ``doc_id`` and text are one document with its number of copies; after the last
    document comes the first. Documents of an id are ordered by the hashes of their texts, rows
    without an id come first.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs)
    parts = partitions(spark)
    starts = _range_starts(keyed, 4 * parts)
    if not starts:
        return spark.createDataFrame([], schema)
    deal = "range int, guest boolean, copies long, " + KEY
    dealt = arrow_map(keyed, lambda b: _dealt(b, starts), deal).repartition(parts, "range")
    ordered = dealt.sortWithinPartitions("range", "guest", "place", "tie", "doc_id")
    return arrow_map(ordered, lambda b: _neighbours(b, function), schema)


def _neighbours(batches: Iterator[pa.RecordBatch], function) -> Iterator[pa.RecordBatch]:
    """Hold a document until the next one of its range, or the range's guest, is there."""
    held = None  # [range, key, copies, text]
    ready: list[tuple] = []
    size = 0
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("range", "guest", "copies", "place", "tie", "doc_id")))
        texts = batch.column("text").cast(pa.large_binary())
        for (number, guest, copies, *key), text in zip(keys, texts):
            if held and held[0] == number and held[1] == key and not guest:
                held[2] += copies
                continue
            text = text.as_py()
            if held and held[0] == number:
                ready.append((held[1][2], held[2], held[3], text))
                size += len(held[3])
            held = None if guest else [number, key, copies, text]
            if size >= BLOCK:
                yield function(*zip(*ready))
                ready, size = [], 0
    if ready:
        yield function(*zip(*ready))


# --- edited texts --------------------------------------------------------------------------


def edited(text: bytes, following: bytes) -> tuple[int, bytes]:
    """Code points of a text, and the text whose last quarter is replaced by the next one's start."""
    if text.isascii() and following.isascii():
        quarter = len(text) // 4
        return len(text), text[: len(text) - quarter] + following[:quarter]
    chars, other = text.decode("utf-8", "surrogateescape"), following.decode("utf-8", "surrogateescape")
    quarter = len(chars) // 4
    changed = chars[: len(chars) - quarter] + other[:quarter]
    return len(chars), changed.encode("utf-8", "surrogateescape")


def _compared(ids, copies, texts, following, ranks: np.ndarray) -> pa.RecordBatch:
    """Fingerprints of texts and their edited forms, and how alike they are."""
    counts, changed = zip(*map(edited, texts, following))
    # Texts follow each other, except where a range ends: those guests are fingerprinted too.
    together = list(texts)
    after = []
    for i, text in enumerate(following):
        if i + 1 < len(texts) and texts[i + 1] is text:
            after.append(i + 1)
        else:
            after.append(len(together))
            together.append(text)
    chains = _chains(together, ranks)
    own, new = chains[: len(texts)], _chains(list(changed), ranks)
    columns = {
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array(counts, pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in changed]),
        "fingerprint": pa.array([encoded(c) for c in own]),
        "edited_fingerprint": pa.array([encoded(c) for c in new]),
        "near_edited": pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
        "near_next": pa.array([likeness(a, chains[j]) for a, j in zip(own, after)], pa.float64()),
    }
    batch = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    if max(copies) > 1:
        batch = batch.take(pa.array(np.repeat(np.arange(len(ids)), copies)))
    return batch


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def edited_fingerprints(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """Every row's fingerprint beside those of its edited text and of the next document.

    In the edited text the last quarter of the code points gives way to the first as many of the
    next document, ascending ``doc_id``, the first after the last. Order and copies are those of
    ``beside_next``, texts those of ``fingerprints``: null is empty, two empty texts are alike (1.0),
    an empty one and another not at all (0.0). An empty table gives no rows.
    """
    known = rarity_ranks(entropy_histogram(docs)) if ranks is None else ranks
    return beside_next(docs, lambda *rows: _compared(*rows, known), COMPARED)


def op12_fingerprints(spark, sf_dir: str) -> DataFrame:
    """All documents and their edited texts, fingerprinted and compared."""
    return edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
