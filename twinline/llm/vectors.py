"""Embedding columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list column as doubles, padded with zeros to ``width``; null rows and components become NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    n = len(column)
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    out = np.zeros((n, width))
    flat = np.asarray(pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
    rows = np.repeat(np.arange(n), lengths)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = flat
    if column.null_count:
        out[np.asarray(column.is_null())] = np.nan
    return out


def packed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
    if len(rows) * size >= 2**31:
        raise ValueError("too many bytes for one batch")
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def unpacked(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """The matrix that ``packed`` was given."""
    if isinstance(column, pa.ChunkedArray):
        chunks = [unpacked(c, width, kind) for c in column.chunks]
        return np.concatenate(chunks) if chunks else np.zeros((0, width), kind)
    if not len(column):
        return np.zeros((0, width), kind)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]]
    return np.frombuffer(raw.tobytes(), dtype=kind).reshape(len(column), width)


def ids(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False))
