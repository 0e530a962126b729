"""Rows that Spark has sorted, group by group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups and the bounds of the groups in them.

    Rows with equal whole-number ``keys`` have to follow each other. Only the group that a
    batch leaves open is held until the next.
    """

    def complete(rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows).combine_chunks()
        columns = [table[k].to_numpy() for k in keys]
        new = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
        for column in columns:
            new |= column[1:] != column[:-1]
        return table, np.concatenate([[0], np.flatnonzero(new) + 1, [table.num_rows]])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting and any(waiting[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield complete(waiting)
            waiting = []
        other = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            column = batch.column(k).to_numpy()
            other |= column != column[-1]
        before = np.flatnonzero(other)
        start = int(before[-1]) + 1 if len(before) else 0
        if start:
            yield complete([*waiting, batch.slice(0, start)])
            waiting = []
        waiting.append(batch.slice(start))
    if waiting:
        yield complete(waiting)
