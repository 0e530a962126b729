"""Fill-in-the-middle over piece tables.

A document is a row of descriptors (buffer, start, stop) over two buffers that never change: the
texts as they came and the sentinels. Cutting splits the one descriptor of a text into three,
an arrangement is a permutation of these and the sentinels', and its inverse restores the text.
Text is only copied where an output is asked for; hashes read the descriptors in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import arrow_map, table
from tidemark.llm.textblocks import SPACES, blocks

# The sentinels, and the forms as orders of these six pieces:
# prefix, middle, suffix, <P>, <S>, <M>.
SENTINELS = (b"<P>", b"<S>", b"<M>")
FORMS = ("plain", "psm", "spm")
ORDERS = np.array([[0, 1, 2, 3, 4, 5], [3, 0, 4, 2, 5, 1], [4, 2, 3, 0, 5, 1]])
INVERSES = np.argsort(ORDERS, axis=1)

CUTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


@dataclass
class PieceTable:
    """Six descriptors a document: ``buffer``, ``start`` and ``stop`` have a row for each."""

    buffers: tuple[memoryview, ...]
    buffer: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    def permuted(self, orders: np.ndarray) -> PieceTable:
        """Every row's descriptors in the row's own order."""
        moved = (np.take_along_axis(x, orders, axis=1) for x in (self.buffer, self.start, self.stop))
        return PieceTable(self.buffers, *moved)

    def first(self, count: int) -> PieceTable:
        """The first ``count`` descriptors of every row."""
        return PieceTable(self.buffers, self.buffer[:, :count], self.start[:, :count], self.stop[:, :count])

    def pieces(self) -> Iterator[list[memoryview]]:
        """The views of each document's descriptors that are not empty."""
        for row in zip(self.buffer.tolist(), self.start.tolist(), self.stop.tolist()):
            yield [self.buffers[b][i:j] for b, i, j in zip(*row) if j > i]

    def texts(self) -> list[bytes]:
        return [b"".join(views) for views in self.pieces()]

    def hashes(self) -> list[str]:
        """SHA-256 of each document, streamed over its descriptors."""
        found = []
        for views in self.pieces():
            digest = hashlib.sha256()
            for view in views:
                digest.update(view)
            found.append(digest.hexdigest())
        return found


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units end, and the first unit of every document (one more at the end).

    A unit is a word with the white space before it; white space at the end of a text is one too.
    """
    ends = np.zeros(len(data) + 1, dtype=bool)
    space = SPACES[data]
    ends[1:-1] = ~space[:-1] & space[1:]
    filled = offsets[1:][offsets[1:] > offsets[:-1]]
    ends[filled] = True
    places = np.flatnonzero(ends)
    return places, np.searchsorted(places, offsets, side="right")


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned numbers drawn for a document; one without an id draws as the empty id."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def cut_block(data: np.ndarray, offsets: np.ndarray, ids: list, seed: int, rate: int, spm: int):
    """``(n, form, places of the two cuts, table of prefix, middle, suffix and sentinels)``."""
    ends, bounds = unit_ends(data, offsets)
    n = np.diff(bounds)
    drawn = np.array([draws(i, seed) for i in ids], dtype=np.int64).reshape(-1, 4)
    whole = data.tobytes()
    form = np.where(drawn[:, 2] % 100 >= rate, 0, np.where(drawn[:, 3] % 100 < spm, 2, 1))
    for row in np.flatnonzero(form).tolist():
        text = whole[offsets[row] : offsets[row + 1]]
        if not text or any(mark in text for mark in SENTINELS):
            form[row] = 0
    units = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
    # The place after u units is the end of the u-th; a plain text is all prefix.
    starts = np.append(ends, 0)[np.maximum(bounds[:-1, None] + units - 1, 0)]
    cuts = np.where(units > 0, starts, offsets[:-1, None])
    cuts = np.where(form[:, None] == 0, offsets[1:, None], cuts)
    marks = np.arange(0, 9, 3) + np.zeros((len(n), 1), np.int64)
    start = np.column_stack([offsets[:-1], cuts, marks])
    stop = np.column_stack([cuts, offsets[1:], marks + 3 * (form > 0)[:, None]])
    buffer = np.repeat([[0, 0, 0, 1, 1, 1]], len(n), axis=0)
    pieces = PieceTable((memoryview(whole), memoryview(b"".join(SENTINELS))), buffer, start, stop)
    return n, form, cuts, pieces


def char_counts(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Code points between places of UTF-8 text."""
    before = np.append(0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int64))
    return before[stop] - before[start]


def split_output(outputs: list[bytes], form: np.ndarray) -> PieceTable:
    """The piece table of texts in their forms, found again by their sentinels alone."""
    offsets = np.append(0, np.cumsum([len(o) for o in outputs], dtype=np.int64))
    edges = np.repeat(offsets[:-1, None], 7, axis=1)
    edges[:, 1:] = offsets[1:, None]
    for row in np.flatnonzero(form).tolist():
        place, found = 0, []
        for mark in ORDERS[form[row]][[0, 2, 4]] - 3:
            place = outputs[row].index(SENTINELS[mark], place)
            found += [place, place + 3]
            place += 3
        edges[row, :6] = offsets[row] + np.array(found)
    buffer = np.zeros((len(outputs), 6), np.int64)
    return PieceTable((memoryview(b"".join(outputs)),), buffer, edges[:, :-1], edges[:, 1:])


def restored_pieces(outputs: list[bytes], form: np.ndarray) -> PieceTable:
    """Prefix, middle and suffix of each output in their own order."""
    return split_output(outputs, form).permuted(INVERSES[form]).first(3)


def _cut_columns(rows: pa.RecordBatch, data, n, form, cuts, offsets) -> dict[str, pa.Array]:
    plain = form == 0
    prefix = char_counts(data, offsets[:-1], cuts[:, 0])
    middle = char_counts(data, cuts[:, 0], cuts[:, 1])
    return {
        "doc_id": rows.column("doc_id"),
        "n": pa.array(n, pa.int64()),
        "form": pa.array([FORMS[f] for f in form]),
        "prefix_chars": pa.array(prefix, pa.int64(), mask=plain),
        "middle_chars": pa.array(middle, pa.int64(), mask=plain),
    }


def _filled(batches: Iterator[pa.RecordBatch], seed: int, rate: int, spm: int, digests: bool):
    for rows, data, offsets in blocks(batches):
        ids = rows.column("doc_id").to_pylist()
        n, form, cuts, pieces = cut_block(data, offsets, ids, seed, rate, spm)
        columns = _cut_columns(rows, data, n, form, cuts, offsets)
        arranged = pieces.permuted(ORDERS[form])
        outputs = arranged.texts()
        if digests:
            columns["output_sha256"] = pa.array(arranged.hashes(), pa.string())
            columns["restored_sha256"] = pa.array(restored_pieces(outputs, form).hashes(), pa.string())
        else:
            columns["output"] = pa.array(outputs, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        outputs = batch.column("output").cast(pa.binary()).fill_null(b"").to_pylist()
        form = np.array([FORMS.index(f) for f in batch.column("form").to_pylist()], dtype=np.int64)
        texts = restored_pieces(outputs, form).texts()
        yield batch.append_column("text", pa.array(texts, pa.binary()).cast(pa.string()))


def fill_in_middle(docs: DataFrame, *, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` of every row.

    ``rate`` of 100 texts are cut into prefix, middle and suffix at two drawn ends of their
    ``n`` units, and ``spm`` of 100 of those have the suffix first. The others, and texts that are
    empty or hold a sentinel, are plain: output as they came, without counts of characters.

    The draw depends on ``seed`` and ``doc_id`` alone, so rows that repeat an id are drawn alike. Null
    text counts as empty; rows without ``doc_id`` are drawn as the empty id. Other columns are
    ignored, and an empty table gives no rows.
    """
    rows = docs.select("doc_id", "text")
    return arrow_map(rows, lambda b: _filled(b, seed, rate, spm, False), CUTS + ", output string")


def restore_text(filled: DataFrame) -> DataFrame:
    """``(doc_id, form, output, text)``: the text rebuilt from output and form alone."""
    rows = filled.select("doc_id", "form", "output")
    return arrow_map(rows, _restored, "doc_id long, form string, output string, text string")


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Every document's cut and form, with hashes of its output and of the text rebuilt from it."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("text"))
    schema = CUTS + ", output_sha256 string, restored_sha256 string"
    return arrow_map(docs, lambda batches: _filled(batches, 42, 50, 80, True), schema)
