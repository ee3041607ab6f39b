"""Texts of an Arrow batch as one byte array with offsets, in parts of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are worked on at once; a longer text is a part of its own.
PART_BYTES = 2 << 20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows joined, and the offsets of the rows; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return values[ends[0] : ends[-1]], ends - ends[0]


def parts(batch: pa.RecordBatch, column: str, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold at most ``limit`` bytes, or one row."""
    _, ends = flat(batch.column(column))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
        yield batch.slice(at, upto - at)
        at = upto


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes from one array and the offsets of the rows; the inverse of ``flat``."""
    data = np.ascontiguousarray(values, np.uint8)
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)],
    )
