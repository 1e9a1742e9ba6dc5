"""Hashes of all words and shingles of a text column, computed over byte arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_draw = np.random.default_rng(20240607)
# fixed values: one odd number per byte, the powers of another by place in the word, and one per place in a shingle
_BYTE = _draw.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_PLACES = 1 << 16
_PLACE = np.cumprod(np.full(_PLACES, np.uint64(0x9E3779B97F4A7C15 | 1)))
_STEP = _draw.integers(1, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits over the whole number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large_string array without nulls, and the bounds of its texts in them."""
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def hash_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, bounds, starts): a hash for every word with A-Z lower-cased, where each text's words begin and end
    in that list, and each word's first byte. Words are runs without white space."""
    raw, ends = raw_bytes(texts)
    space = _SPACE[raw]
    first = ~space
    first[1:] &= space[:-1]
    inner = ends[1:-1]
    inner = inner[inner < len(raw)]
    first[inner] = ~space[inner]
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, ends)
    if not len(starts):
        return np.empty(0, np.uint64), bounds, starts
    runs = np.concatenate([[0], starts])
    place = np.arange(len(raw)) - np.repeat(runs, np.diff(np.append(runs, len(raw))))
    values = _BYTE[raw] * _PLACE[place % _PLACES]
    values[space] = 0
    return mixed(np.add.reduceat(values, starts)), bounds, starts


def hash_shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of all runs of ``size`` words; of a shorter text, its whole sequence; of none, nothing."""
    counts = np.diff(bounds)
    sums = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        sums += words[k:len(words) - size + 1 + k] * _STEP[k]
    short = (counts > 0) & (counts < size)
    sizes = np.where(short, 1, np.maximum(counts - size + 1, 0))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(ends[-1], np.uint64)
    spots = np.arange(ends[-1]) - np.repeat(ends[:-1] - bounds[:-1], sizes)
    whole = np.repeat(~short, sizes)
    out[whole] = sums[spots[whole]]
    for i in np.flatnonzero(short):
        n = counts[i]
        out[ends[i]] = np.append(words[bounds[i]:bounds[i + 1]] * _STEP[:n], _STEP[40 + n % 24]).sum()
    return mixed(out), ends
