"""64-bit hashes of words and word shingles for many texts at once."""

from __future__ import annotations

import numpy as np

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ORDER = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64
)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit integers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word, and the offsets of the texts in them."""
    data = _LOWER[data] if lower else data
    inside = ~_SEPARATOR[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    spans = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    powers = np.full(int(spans.max()), _BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    value = (data[starts[0] :].astype(np.uint64) + np.uint64(1)) * powers[place]
    value[~inside[starts[0] :]] = 0
    sums = np.add.reduceat(value, starts - starts[0])
    return mix(sums), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word shingles of each text, ascending by hash, and the offsets of the texts.

    A text of fewer words than ``size`` has one shingle, the whole sequence; a text without words none.
    """
    words, ends = word_hashes(data, offsets, lower=True)
    n = np.diff(ends)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    after = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(n)), counts)
    start = ends[doc] + np.arange(after[-1]) - after[doc]
    used = np.minimum(n, size)[doc]
    padded = np.append(words, np.zeros(size, np.uint64))
    sums = used.astype(np.uint64) * _BASE
    for j in range(size):
        part = padded[start + j] * _ORDER[j % 5] + np.uint64(j // 5)
        sums += np.where(j < used, part, np.uint64(0))
    hashes = mix(sums)
    for a, b in zip(after[:-1], after[1:]):
        hashes[a:b].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[keep], np.concatenate([[0], np.cumsum(keep)])[after]


def set_ids(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set: equal sets have equal ids. 0 for an empty set."""
    sums = np.zeros(len(ends) - 1, np.uint64)
    full = ends[:-1] < ends[1:]
    if full.any():
        sums[full] = np.add.reduceat(mix(hashes + _BASE), ends[:-1][full])
        sums[full] = mix(sums[full] + np.diff(ends)[full].astype(np.uint64) * _ORDER[0])
    return sums.view(np.int64)
