"""Words and shingles of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of bytes other than space and 09-0D, with A-Z lower-cased. All separators are ASCII, so working on
UTF-8 bytes never splits a character. Words are named by 64-bit hashes: random byte values in a polynomial
modulo 2^64, mixed with the length. Texts are processed whole, a few MB at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled in one go; a longer single text is handled alone.
CHUNK_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_rng = np.random.default_rng(20240607)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUES[65:91] = _VALUES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(n * 5 // 4, base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words(NamedTuple):
    """Words of consecutive texts: text k has words ``bounds[k]:bounds[k + 1]``."""

    bounds: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about CHUNK_BYTES of text; null is empty."""
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> Words:
    """``space`` tells which of the 256 bytes part words."""
    n = len(data)
    inside = ~space[data]
    breaks = offsets[(offsets > 0) & (offsets < n)]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[breaks] = inside[breaks]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[breaks - 1] = inside[breaks - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * _power("up", _BASE, n), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _power("down", _INVERSE, n + 1)[starts] + (ends - starts).astype(np.uint64))
    return Words(np.searchsorted(starts, offsets), hashes, starts, ends, data)


def bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in one of the closed ranges."""
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first : last + 1] = True
    return out


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash), sorted by both: the distinct runs of ``size`` words of each text.

    A text with fewer words has one shingle, all its words; one without words has none.
    """
    counts = np.diff(w.bounds)
    n = len(w.hashes)
    owner = np.repeat(np.arange(len(counts)), counts)
    full = np.zeros(n, bool)
    left = np.repeat(w.bounds[1:], counts) - np.arange(n)
    full[left >= size] = True
    whole = np.flatnonzero((counts > 0) & (counts < size))
    at = np.flatnonzero(full)
    made = np.zeros(len(at), np.uint64)
    for k in range(size):
        made = mix(made * np.uint64(3) + w.hashes[at + k] + np.uint64(size))
    short = np.zeros(len(whole), np.uint64)
    for k in range(size - 1):
        here = counts[whole] > k
        step = mix(short * np.uint64(3) + w.hashes[np.minimum(w.bounds[whole] + k, max(n - 1, 0))] + np.uint64(size)) if n else short
        short = np.where(here, step, short)
    short = mix(short + counts[whole].astype(np.uint64) * _BASE)
    doc, value = np.concatenate([owner[at], whole]), np.concatenate([made, short])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]
