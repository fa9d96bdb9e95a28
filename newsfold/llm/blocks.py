"""Texts of Arrow batches as flat byte arrays, and their words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20

#: White space of all word rules here: 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the row offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None:
        return np.zeros(0, dtype=np.uint8), at - at[0]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, size: int = BLOCK_BYTES):
    """``(rows, bytes, offsets)`` with at most ``size`` bytes of text each; a longer text is a block of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = flat(batch.column(column))
        row = 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
            part = offsets[row : to + 1]
            yield batch.slice(row, to - row), data[part[0] : part[-1]], part - part[0]
            row = to


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every maximal run without white space, and each row's offsets into these words."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    start[filled] = solid[filled]
    end = solid.copy()
    end[:-1] &= ~solid[1:]
    last = filled[1:] - 1
    end[last] = solid[last]
    end[-1] = solid[-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """The given byte ranges, which are in order and don't overlap, as one binary array."""
    length = ends - starts
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(length, out=at[1:])
    if at[-1] != len(data):
        inside = np.zeros(len(data) + 1, dtype=np.int8)  # ranges are not empty, so starts differ
        inside[starts] = 1
        inside[ends] -= 1
        data = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    kind = pa.large_binary() if at[-1] > 2**31 - 1 else pa.binary()
    at = at.astype(np.int64 if at[-1] > 2**31 - 1 else np.int32)
    return pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + length]`` one after the other."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    step = np.ones(total, dtype=np.int64)
    some = lengths > 0
    firsts = (ends - lengths)[some]
    begin = starts[some]
    step[0] = begin[0]
    step[firsts[1:]] = begin[1:] - (begin[:-1] + lengths[some][:-1] - 1)
    return values[np.cumsum(step)]
