"""Words and their hashes for whole Arrow batches of texts, as numpy arrays; used inside tasks.

A word's hash is the sum of random 64-bit codes of its bytes, each times a power of an odd base, taken modulo 2**64:
sums of a stretch come from running sums, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are expanded into arrays at a time; a longer text is one piece of its own.
PIECE_BYTES = 1 << 19

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def codes(seed: int, lower: bool = True) -> np.ndarray:
    """A random 64-bit code for every byte; with ``lower``, A-Z have the codes of a-z."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed))
    if lower:
        table[65:91] = table[97:123]
    return table


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, b, np.uint64))])
                     for b in (_BASE, _INVERSE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(PIECE_BYTES, 1 << int(n - 1).bit_length() if n > 1 else 1))


def text_pieces(batch: pa.RecordBatch, text: str = "text",
                size: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """first row, bytes and row offsets of consecutive pieces of a batch; nulls are empty texts."""
    col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and row of every maximal stretch of ``inside`` bytes within one row."""
    n = len(inside)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:-1]
    end[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def running(values: np.ndarray) -> np.ndarray:
    """Sums of all leading stretches of byte codes, each code times a power of the base."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][:len(values)], out=out[1:])
    return out


def stretch(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of stretches, independent of where they stand."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``size`` words of one row; a shorter row is one run of all its words."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factor = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k, 1 << 64)) for k in range(size)]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    count = np.diff(np.r_[first, n])
    full = np.zeros(n, bool)
    if n >= size:
        full[:n - size + 1] = rows[:n - size + 1] == rows[size - 1:]
    at = np.flatnonzero(full)
    value = np.zeros(len(at), np.uint64)
    for k in range(size):
        value += hashes[at + k] * factor[k]
    short = np.flatnonzero(count < size)
    rest = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = count[short] > k
        rest[has] += hashes[first[short[has]] + k] * factor[k]
    rest += count[short].astype(np.uint64)
    value, at = np.r_[value, rest], np.r_[at, first[short]]
    order = np.argsort(at, kind="stable")
    return mix(value[order]), at[order]
