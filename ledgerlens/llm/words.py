"""Words of whole Arrow batches, found and hashed without a Python object per word.

A word is a run of anything but space and the controls 9 to 13.  Words get 64-bit
hashes: a polynomial over random 64-bit values of their bytes, mixed at the end.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_U = np.uint64
_SEP = np.zeros(256, bool)
_SEP[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(20240101).integers(1, 2 ** 63, 256, dtype=_U) | _U(1)
_BYTE[_SEP] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE_LOWER[97:123]
_BASE = _U(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    data: np.ndarray    # bytes of all texts of the batch
    start: np.ndarray   # of each word in data
    end: np.ndarray
    first: np.ndarray   # of each document in the words, and their number at the end
    hash: np.ndarray    # of each word


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    at = at.astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False,
                between: np.ndarray = _SEP) -> Words:
    """Words of the texts that ``offsets`` cut out of ``data``; ``between``: which bytes part words."""
    sep = between[data]
    opens = ~sep
    opens[1:] &= sep[:-1]
    begin = offsets[:-1][offsets[:-1] < len(data)]
    opens[begin] = ~sep[begin]
    start = np.flatnonzero(opens)
    if not len(start):
        none = np.empty(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64), np.empty(0, _U))
    stops = ~sep
    stops[:-1] &= sep[1:] | opens[1:]
    end = np.flatnonzero(stops) + 1
    place = np.arange(start[0], len(data), dtype=np.int32 if len(data) < 2 ** 31 else np.int64)
    place -= np.repeat(start, np.diff(np.append(start, len(data)))).astype(place.dtype)
    powers = np.cumprod(np.concatenate([[_U(1)], np.full(int((end - start).max()), _BASE)]), dtype=_U)
    np.minimum(place, len(powers) - 1, out=place)
    value = (_BYTE_LOWER if lower else _BYTE)[data[start[0]:]] * powers[place]
    value[sep[start[0]:]] = 0
    return Words(data, start, end, np.searchsorted(start, offsets), mix64(np.add.reduceat(value, start - start[0])))


def batches_of(batches: Iterator[pa.RecordBatch], text: int, limit: int = 1 << 20, rows: int = 16_384) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text and at most ``rows`` rows."""
    for b in batches:
        _, offsets = text_bytes(b.column(text))
        at = 0
        while at < b.num_rows:
            stop = max(at + 1, min(at + rows, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
            yield b.slice(at, stop - at)
            at = stop


def give_back() -> None:
    """Return to the system what this worker has freed; the allocators keep it for the next task otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def grams(hashes: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of n word hashes (documents are not told apart here)."""
    if len(hashes) < n:
        return np.empty(0, _U)
    factor = _U((0xD6E8FEB86659FD93 * (2 * seed + 1)) % 2 ** 64 | 1)
    out = hashes[:len(hashes) - n + 1].copy()
    for k in range(1, n):
        out *= factor
        out += hashes[k:len(hashes) - n + 1 + k]
    return mix64(out + _U(n))


_ANY_BYTE = np.random.default_rng(20240102).integers(1, 2 ** 63, 256, dtype=_U) | _U(1)


def hash_runs(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes; a run ends where the next begins."""
    place = np.arange(start[0], len(data), dtype=np.int64)
    size = np.diff(np.append(start, len(data)))
    place -= np.repeat(start, size)
    powers = np.cumprod(np.concatenate([[_U(1)], np.full(int(size.max()), _BASE)]), dtype=_U)
    return mix64(np.add.reduceat(_ANY_BYTE[data[start[0]:]] * powers[place], start - start[0]) + size.astype(_U))
