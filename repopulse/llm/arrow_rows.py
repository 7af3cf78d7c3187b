"""Helpers for functions that map Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def pieces(batches: Iterator[pa.RecordBatch], most: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task makes from one batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Groups of consecutive rows with equal values of ``column``; a group may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if held and keys[start] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = keys[start]
    if held:
        yield pa.Table.from_batches(held)
