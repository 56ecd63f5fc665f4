"""Vectorised passes over Arrow strings as UTF-8 bytes.

Rows of a batch lie end to end in one byte array; ``off`` holds where each row begins. Slices keep working arrays small whatever
the length of single texts; a text is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 512 << 10
_libc = ctypes.CDLL(None)

_M = np.uint64(0xFF51AFD7ED558CCD)
_N = np.uint64(0xC4CEB9FE1A85EC53)
_S = np.uint64(33)
#: Base of the polynomial over bytes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_CODE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_CODE = BYTE_CODE[LOWER]

SPACE_WORD = np.ones(256, bool)
SPACE_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x41:0x5B] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> _S)
    x *= _M
    x ^= x >> _S
    x *= _N
    x ^= x >> _S
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and INVERSE**i for i below n."""
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1024)
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows end to end, and their offsets; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def trim() -> None:
    """Gives freed memory back to the system, as Python workers stay while other stages run."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``limit`` bytes, or one longer text."""
    _, off = utf8(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(off, off[begin] + limit, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end
    trim()


def word_bounds(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the row it is in; words don't cross rows."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = is_word[data]
    joined = np.zeros(n + 1, bool)  # position continues the word before it
    joined[1:n] = inside[1:] & inside[:-1]
    joined[off] = False
    starts = np.flatnonzero(inside & ~joined[:n])
    ends = np.flatnonzero(inside & ~joined[1:]) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray = BYTE_CODE) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def per_row(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each row's entries in ``rows``, which is sorted."""
    at = np.arange(n)
    return np.searchsorted(rows, at, "left"), np.searchsorted(rows, at, "right")
