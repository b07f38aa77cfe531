"""Stretches of an Arrow batch that hold about so many bytes of text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc


def blocks(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices that end where ``column`` has come to ``most_bytes``.

    A slice has one row at least, however long. What a worker makes of a slice is bounded
    by this and not by the number of rows in a batch.
    """
    first, total = 0, 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        total += size
        if total >= most_bytes:
            yield batch.slice(first, i + 1 - first)
            first, total = i + 1, 0
    if first < len(batch):
        yield batch.slice(first)
