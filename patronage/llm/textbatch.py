"""Work on whole Arrow batches of text as flat byte arrays.

A batch is taken in blocks of about ``BLOCK_BYTES``; a longer text is a block
of its own. Everything is numpy over the bytes of a block, so memory follows
the block and not the batch, and no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20

# The white space of the word rule [^\x20\x09-\x0D]+.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Lower case for A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = 0x9E3779B97F4A7C15
_UNDO = pow(_ODD, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the 0th to (n-1)th power, modulo 2 to the 64th."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK_BYTES), base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the start of each row, with one end more; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[starts[0] : starts[-1]], starts - starts[0]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, starts)`` for runs of rows with about ``limit`` bytes, one row at least."""
    data, starts = bytes_of(column)
    row, rows = 0, len(starts) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, side="right")) - 1)
        end = min(end, rows, row + 20_000)
        yield row, data[starts[row] : starts[end]], starts[row : end + 1] - starts[row]
        row = end


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of every word of a block."""
    if len(data) == 0:
        return (np.zeros(0, np.int64),) * 3
    inside = ~SPACE[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[starts] = True
    held = np.zeros(len(data), dtype=bool)
    held[1:] = inside[:-1] & ~border[1:-1]
    begin = np.flatnonzero(inside & ~held)
    held[:-1] = inside[1:] & ~border[1:-1]
    held[-1] = False
    end = np.flatnonzero(inside & ~held) + 1
    return begin, end, np.searchsorted(starts, begin, side="right") - 1


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit value of the bytes of every span, the same wherever the span stands."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers(_ODD, len(data)), out=total[1:])
    value = (total[end] - total[begin]) * powers(_UNDO, len(data) + 1)[begin]
    return mix(value + (end - begin).astype(np.uint64))


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenation of ``[start, start + length)``."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def strings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Spans of a block as a string column."""
    lengths = end - begin
    offsets = np.zeros(len(begin) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    flat = data[gather(begin, lengths)]
    return pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes()))


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Consecutive runs of ``counts`` values as a list column."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
