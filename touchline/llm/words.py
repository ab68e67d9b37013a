"""Words, lines and windows of many texts at once, as numpy arrays over their UTF-8 bytes.

A segment is a maximal run of bytes that are not separators. Its hash is 64 bits of a multilinear
hash (a random value per byte, times a random weight per place), mixed at the end: texts chosen
without knowledge of the tables collide with a chance near 2**-64 per pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from touchline.llm.shared import ship

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit values."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


GOLDEN = 0x9E3779B97F4A7C15
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN))


def weights(n: int) -> np.ndarray:
    """Odd 64-bit weights of the first ``n`` places."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(1 << 40)) * np.uint64(GOLDEN)) | np.uint64(1)


@dataclass
class Segments:
    """Segments of ``n`` texts: byte ranges, hashes, and ``ends[i]`` segments before text ``i + 1``."""

    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def run_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hashes of the runs that begin at ``start`` and together cover all bytes."""
    length = np.diff(np.append(start, len(data)))
    place = np.arange(len(data))
    place -= np.repeat(start, length)
    value = weights(int(length.max(initial=1)))[place]
    del place
    value *= BYTE_VALUE[data]
    return mix(np.add.reduceat(value, start) + length.astype(np.uint64) * np.uint64(GOLDEN))


def segments(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, prefixes: tuple[int, ...] = ()):
    """Segments of all texts; with ``prefixes``, also the hashes of each segment's first bytes."""
    n, inside = len(data), ~separator[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    closes = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[closes] = inside[closes]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(start, offsets)
    if not len(start):
        empty = np.zeros(0, np.uint64)
        return Segments(start, stop, empty, bounds), [empty for _ in prefixes]
    place = np.arange(n)
    place[start[0] :] -= np.repeat(start, np.diff(np.append(start, n)))
    place[~inside] = 0
    value = BYTE_VALUE[data]
    value[~inside] = 0
    value *= weights(int((stop - start).max()) if len(start) else 1)[place]
    length = (stop - start).astype(np.uint64)
    whole = mix(np.add.reduceat(value, start) + length * np.uint64(GOLDEN))
    heads = []
    for k in prefixes:
        cut = np.where(place < k, value, np.uint64(0))
        heads.append(mix(np.add.reduceat(cut, start) + np.minimum(length, np.uint64(k)) * np.uint64(GOLDEN) + np.uint64(k)))
    return Segments(start, stop, whole, bounds), heads


def windows(found: Segments, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` segments in a row within a text, and the places where the texts meet."""
    starts = np.maximum(found.counts() - k + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(starts)])
    at = np.arange(bounds[-1]) + np.repeat(found.bounds[:-1] - bounds[:-1], starts)
    total = np.zeros(len(at), np.uint64)
    for weight, j in zip(weights(k), range(k), strict=True):
        total += found.hash[at + j] * weight
    return mix(total + np.uint64(k)), bounds


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


ship(__name__)
