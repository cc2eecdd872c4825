"""Arrow text columns as NumPy arrays of code points, and hashes of runs of them.

A batch is handled in chunks of whole documents, about ``CHUNK_BYTES`` of UTF-8 each, so the temporary arrays stay a
fixed multiple of the chunk; a document larger than that is a chunk of its own.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
#: For work whose temporary arrays are many times as large as its chunk.
SMALL_CHUNK_BYTES = 1 << 18
CODE_POINTS = 0x110000
_U = np.uint64
#: Odd multiplier of the run hashes, its inverse modulo 2**64, and the steps of the 64-bit finaliser.
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _M1
    x ^= x >> _U(27)
    x *= _M2
    x ^= x >> _U(31)
    return x


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, code points, offsets) of each chunk; null texts are empty.

    ``offsets`` has one entry more than the chunk has rows and counts code points.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64, count=n + column.offset + 1)[column.offset :]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + chunk_bytes, side="right")) - 1
        end = min(max(end, row + 1), n)
        own = data[offsets[row] : offsets[end]]
        points = np.frombuffer(own.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        local = offsets[row : end + 1] - offsets[row]
        if len(points) != len(own):
            starts = np.concatenate(([0], np.cumsum((own & 0xC0) != 0x80)))
            local = starts[local]
        yield row, end, points, local
        row = end


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """Lower case of each code point where that is one code point too."""
    table = np.arange(CODE_POINTS, dtype=np.uint32)
    for c in range(0x1E944):  # cased letters end there
        if len(low := chr(c).lower()) == 1:
            table[c] = ord(low)
    return table


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Whether each code point is a letter (general category L)."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(CODE_POINTS)], dtype=bool)


@lru_cache(maxsize=8)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_P, _PINV):
        powers = np.full(size, base, dtype=_U)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the values of each run [start, end); equal runs hash alike wherever they stand."""
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _powers(1 << max(10, int(len(values)).bit_length()))
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum(mix(values.astype(_U) + _U(1)) * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _M2)


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document index of the maximal runs of True, cut at document borders."""
    if not len(mask):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    border = np.zeros(len(mask) + 1, bool)
    border[offsets] = True
    before = np.concatenate(([False], mask[:-1]))
    after = np.concatenate((mask[1:], [False]))
    starts = np.flatnonzero(mask & (~before | border[:-1]))
    ends = np.flatnonzero(mask & (~after | border[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring ``bounds``; an empty segment sums to zero."""
    rows = len(bounds) - 1
    out = np.zeros((rows, *values.shape[1:]), dtype=values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        # the starts of the non-empty segments partition the values, as nothing lies between them
        out[full] = np.add.reduceat(values[: bounds[-1]], bounds[full], axis=0)
    return out
