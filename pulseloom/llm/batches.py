"""Record batches of texts, cut by bytes instead of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8; a NULL is an empty one."""
    return [t or b"" for t in batch.column(column).cast(pa.large_binary()).to_pylist()]


def text_slices(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of the batches with texts of ``limit`` bytes at most, or of one row."""
    for batch in batches:
        sizes = np.array([len(t) for t in texts_of(batch, column)], np.int64)
        ends, low = np.cumsum(sizes), 0
        while low < batch.num_rows:
            before = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(low, high - low)
            low = high
