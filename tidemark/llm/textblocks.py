"""Whole texts as byte arrays: what the numpy parts of the operators share.

A block is some documents in a row whose texts lie one after another in one array of
bytes. Blocks are cut from Arrow batches so that working arrays, several times as large as
the text, stay small; only a single text above the limit makes a larger block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased, as ``LOWER[data]``."""
    return data | ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))


def _powers(base: int, count: int) -> np.ndarray:
    """The first powers of a number modulo 2**64, from the power 0."""
    found = np.full(count, base % 2**64, np.uint64)
    found[:1] = 1
    return np.multiply.accumulate(found)


STRIP = 1 << 14
INVERSE = pow(int(MULTIPLIER), -1, 2**64)
WITHIN, BACK_WITHIN = _powers(int(MULTIPLIER), STRIP), _powers(INVERSE, STRIP)
BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's texts as one byte array and the offsets of the texts; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    count = len(column)
    if count == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + count + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(count + 1, np.int64)
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return text, offsets - offsets[0]


def blocks(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with some ``limit`` bytes of text, their bytes and offsets."""
    for batch in batches:
        data, offsets = bytes_of(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield (
                batch.slice(first, last - first),
                data[offsets[first] : offsets[last]],
                offsets[first : last + 1] - offsets[first],
            )
            first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, cuts=None) -> tuple[np.ndarray, ...]:
    """The 64-bit hash, start and length of every word, and the first word of every document (one
    more at the end).

    Words are runs of bytes other than white space (9-13, 32); none crosses a document. ``cuts``
    takes the starts of all words and returns places in words at which they are cut in two.
    """
    inside = (data != 32) & (data - np.uint8(9) > 4)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    opens[begins] = inside[begins]
    starts = np.flatnonzero(opens)
    if cuts is not None:
        opens[cuts(starts)] = True
        starts = np.flatnonzero(opens)
    bounds = np.searchsorted(starts, offsets)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), starts, starts, bounds
    packed = data[inside]
    first = np.flatnonzero(opens[inside])
    lengths = np.diff(np.append(first, len(packed)))
    # A byte counts times the power of its place in its word. Here it is that of its place among all, a
    # product of a strip's and of one within the strip; each word's sum is then brought back to its first.
    terms = np.empty(len(packed), np.uint64)
    strips = -(-len(packed) // STRIP)
    for start, power in zip(range(0, len(packed), STRIP), _powers(int(WITHIN[-1]) * int(MULTIPLIER), strips)):
        strip = terms[start : start + STRIP]
        np.take(BYTE_CODES, packed[start : start + STRIP], out=strip, mode="clip")
        strip *= WITHIN[: len(strip)]
        strip *= power
    sums = np.add.reduceat(terms, first)
    sums *= BACK_WITHIN[first % STRIP]
    sums *= _powers(int(BACK_WITHIN[-1]) * INVERSE, strips)[first // STRIP] * MULTIPLIER
    return mixed(sums + lengths.astype(np.uint64)), starts, lengths, bounds


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the first word of every document, see ``word_spans``."""
    hashes, _, _, bounds = word_spans(data, offsets)
    return hashes, bounds


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence where it is shorter."""
    if len(words) == 0:
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64)
    for place in range(width):
        factor = pow(int(MULTIPLIER), place + 1, 2**64) | 1
        total += words[place : place + count] * np.uint64(factor)
    return mixed(total)
