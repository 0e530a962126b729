"""Token counts of whole documents, huge ones in overlapping chunks.

A byte-level tokenizer splits a text before it merges, and never merges across a split. A
position with white space after something else is always such a split, whatever comes
before and after: it is a proven stable boundary. A huge document is encoded in chunks that
overlap, with offsets. Two neighbours are spliced at a stable boundary inside their overlap
where both have a token start; the overlap is widened, twice as far each time, until there is
one. Shorter documents are cut at the same boundaries into pieces, which a bounded memory
spares from being encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import arrow_map, table
from tidemark.llm.textblocks import blocks
from tidemark.llm.tokens import PIECE, has_odd_space, memory, sums_by, tokenizer, word_ids, word_memory

CHUNK = 65_536
OVERLAP = 256
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def stable(text: str, place: int) -> bool:
    """White space after a character that no tokenizer takes for white space."""
    return text[place] in " \t\n\x0b\x0c\r" and not text[place - 1].isspace() and text[place - 1] > " "


def spliced_ids(encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Ids of ``text``, encoded in chunks of ``chunk`` characters that overlap.

    ``encoder`` is a tokenizer whose offsets count characters.
    """
    ids: list[int] = []
    begin, start = 0, 0  # where the chunk begins; from where on its tokens count
    while True:
        edge, wider = begin + chunk, overlap
        if edge + wider >= len(text):
            last = encoder.encode(text[begin:], add_special_tokens=False)
            ids += [i for i, (a, _) in zip(last.ids, last.offsets) if begin + a >= start]
            return ids
        left = encoder.encode(text[begin : edge + wider], add_special_tokens=False)
        while True:
            right = encoder.encode(text[edge : edge + wider], add_special_tokens=False)
            common = {begin + a for a, _ in left.offsets} & {edge + a for a, _ in right.offsets}
            common = [p for p in common if edge < p < edge + wider and stable(text, p)]
            if common or edge + wider >= len(text):
                break
            wider *= 2
            left = encoder.encode(text[begin : edge + wider], add_special_tokens=False)
        if not common:  # widened to the end: the chunk is the rest of the text
            ids += [i for i, (a, _) in zip(left.ids, left.offsets) if begin + a >= start]
            return ids
        cut = min(common)
        ids += [i for i, (a, _) in zip(left.ids, left.offsets) if start <= begin + a < cut]
        begin, start = edge, cut


def _counts(batches: Iterator[pa.RecordBatch], path: str, limit: int, chunk: int, overlap: int):
    """Count the tokens of each text of Arrow batches."""
    known = memory(path)
    for rows, data, offsets in blocks(batches):
        whole = data.tobytes()
        odd = has_odd_space(whole)
        sizes = np.diff(offsets)
        totals = np.zeros(len(sizes), np.int64)
        pieces: list[bytes] = []
        cut = []  # (row, pieces)
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            text = whole[a:b]
            if len(text) > chunk:
                totals[i] = len(spliced_ids(tokenizer(path), text.decode(), chunk, overlap))
            elif odd and has_odd_space(text):
                totals[i] = len(tokenizer(path).encode(text.decode(), add_special_tokens=False))
            else:
                found = PIECE.findall(text)
                cut.append((i, len(found)))
                pieces += found
        if cut:
            which, lengths = zip(*cut)
            places = known.places(pieces)
            totals[list(which)] = sums_by(lengths, known.counts[places])
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(sizes), pa.array(totals), pa.array(totals > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )


def token_counts(
    docs: DataFrame, path: str, *, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every row.

    ``path`` is a byte-level tokenizer file that every executor can read. No tokens are added;
    special strings inside texts count as the library reads them. Texts of more than ``chunk``
    bytes go through overlapping chunks. Null text counts as empty, with no token; repeated
    rows and rows without ``doc_id`` are counted each.
    """
    rows = docs.select("doc_id", F.col("text"))
    return arrow_map(rows, lambda batches: _counts(batches, path, limit, chunk, overlap), COUNTS)


def _lengths(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    known = word_memory(path)
    for rows, data, offsets in blocks(batches):
        _, edges = word_ids(known, data, offsets)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(np.diff(edges) + 1)], ["doc_id", "n_tokens"]
        )


def sequence_lengths(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_tokens)`` of every row: subword ids of its text and an end.

    ``path`` is a tokenizer file that drops white space and ignores case. Null text is empty.
    """
    return arrow_map(docs.select("doc_id", "text"), lambda b: _lengths(b, path), "doc_id long, n_tokens long")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of all documents."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)
