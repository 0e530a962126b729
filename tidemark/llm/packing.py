"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces are taken longest first. Each goes to the open bin, of whatever size, that it fills
best; if none has room, a bin of the least-cost size is opened. Opening sizes are optimised
jointly with what they lead to: every permitted size is tried as the one to open by
preference, as is the one that is cheapest per token, and the cheapest outcome counts after
each bin has been downsized to the least permitted length that holds its contents.

Spark deals the pieces to shards by hash; a task packs a shard in bounded runs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.mixing import n_tokens
from tidemark.llm.store import arrow_map, partitions, stored, table
from tidemark.llm.tokencount import sequence_lengths

SIZES = (512, 1024, 2048, 4096)
RUN = 20_000
PACKED = (
    "doc_id long, piece int, n_tokens int, shard int, run int, bin int, bin_size int, place int"
)


def cost(size: int) -> float:
    """Of one sequence: a fixed part, one per token, and attention's square."""
    return 256 + size + size * size / 8192


def best_fit(lengths: Sequence[int], sizes: Sequence[int], opened: Sequence[int]) -> tuple[list, list, list]:
    """Put each length into the fullest open bin with room; ``opened[i]`` is a new bin's size.

    Returns each length's bin and place in it, and the contents of the bins. Open bins are
    stacked by the room they have left; the set bits of one integer are the rooms there are.
    """
    stacks: dict[int, list[int]] = {}
    rooms = 0
    bins, places, filled = [], [], []
    for length, size in zip(lengths, opened):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            stack = stacks[room]
            number = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, number = size, len(filled)
            filled.append(0)
        bins.append(number)
        places.append(filled[number])
        filled[number] += length
        left = room - length
        if left:
            stacks.setdefault(left, []).append(number)
            rooms |= 1 << left
    return bins, places, filled


def pack(lengths: np.ndarray, sizes: Sequence[int] = SIZES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, place and final bin size of each length; ``lengths`` descend, none above the largest size."""
    sizes = sorted(sizes)
    order = lengths.tolist()
    left = np.cumsum(lengths[::-1])[::-1]  # tokens from here on: a bin is never fuller than that
    least = np.searchsorted(sizes, lengths)
    policies = []
    for preferred in range(len(sizes)):
        policies.append([sizes[max(preferred, i)] for i in least])
    per_token = np.array([cost(s) / np.minimum(s, np.maximum(left, 1)) for s in sizes])
    per_token[np.arange(len(sizes))[:, None] < least[None, :]] = np.inf
    policies.append([sizes[i] for i in per_token.argmin(axis=0)])
    best = None
    for opened in policies:
        bins, places, filled = best_fit(order, sizes, opened)
        final = [sizes[i] for i in np.searchsorted(sizes, filled)]
        total = sum(cost(size) for size in final)
        if best is None or total < best[0]:
            best = (total, bins, places, final)
    _, bins, places, final = best
    bins = np.array(bins, np.int32)
    return bins, np.array(places, np.int32), np.array(final, np.int32)[bins]


def _packed(batches: Iterator[pa.RecordBatch], sizes: Sequence[int], run: int) -> Iterator[pa.RecordBatch]:
    """Pack sorted rows, shard after shard, in runs of at most ``run`` pieces."""
    waiting: list[pa.RecordBatch] = []
    held, open_shard, number = 0, None, 0

    def packed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(waiting).combine_chunks()
        bins, places, size = pack(rows["n_tokens"].to_numpy(), sizes)
        names = ["doc_id", "piece", "n_tokens", "shard"]
        columns = [rows[c].combine_chunks() for c in names]
        columns += [pa.array(np.full(len(bins), number, np.int32)), pa.array(bins), pa.array(size), pa.array(places)]
        return pa.RecordBatch.from_arrays(columns, [*names, "run", "bin", "bin_size", "place"])

    for batch in batches:
        shards = batch.column("shard").to_numpy()
        start = 0
        while start < len(shards):
            if shards[start] != open_shard:
                if held:
                    yield packed()
                    waiting, held = [], 0
                open_shard, number = shards[start], 0
            end = start + int(np.searchsorted(shards[start:], open_shard, side="right"))
            end = min(end, start + run - held)
            waiting.append(batch.slice(start, end - start))
            held += end - start
            start = end
            if held == run:
                yield packed()
                waiting, held = [], 0
                number += 1
    if held:
        yield packed()


def best_fit_packing(
    docs: DataFrame,
    *,
    sizes: Sequence[int] = SIZES,
    length: Column | None = None,
    run: int = RUN,
) -> DataFrame:
    """One row per piece: ``(doc_id, piece, n_tokens, shard, run, bin, bin_size, place)``.

    ``length`` is a document's number of tokens, ``n_tokens()`` by default. A document longer
    than the largest size is cut into full pieces and a rest; nothing is dropped. A sequence
    is named by shard, run and bin, has ``bin_size`` tokens, and the piece starts at ``place``.
    Shards have some ``run`` pieces each, dealt by ``doc_id``, piece and row, so neither very many rows of
    one ``doc_id`` nor rows without one come to the same; should one hold more, it is packed in
    several runs. Pieces are stored before they are dealt: what is repeated is dealt alike.

    Null or empty text has length one (its end). Lengths that are null or below one make no
    piece. Repeated rows are packed each. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    largest = max(sizes)
    rows = docs.select(
        "doc_id",
        (n_tokens() if length is None else length).cast("long").alias("n"),
        F.monotonically_increasing_id().alias("row"),
    )
    last = F.ceil(F.col("n") / largest).cast("int") - 1
    pieces = rows.where("n >= 1").select("doc_id", "n", "row", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    pieces = pieces.select(
        "doc_id", "row", "piece", F.least(F.lit(largest), F.col("n") - F.col("piece") * largest).cast("int").alias("n_tokens")
    )
    pieces = stored(pieces, "pieces")
    shards = max(1, -(-pieces.count() // run))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(shards)).cast("int")
    dealt = pieces.withColumn("shard", shard).repartition(min(shards, 64 * partitions(spark)), "shard")
    ordered = dealt.drop("row").sortWithinPartitions("shard", F.desc("n_tokens"), "doc_id", "piece")
    return arrow_map(ordered, lambda batches: _packed(batches, sizes, run), PACKED)


def subword_packing(docs: DataFrame) -> DataFrame:
    """``best_fit_packing`` of the documents' lengths in ids of a public tokenizer, ends included."""
    import public_tokenizers

    lengths = sequence_lengths(docs, public_tokenizers.path("word_bpe_49k.json"))
    return best_fit_packing(lengths, length=F.col("n_tokens"))


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 512 to 4096 subword tokens."""
    return subword_packing(table(spark, sf_dir, "documents"))
