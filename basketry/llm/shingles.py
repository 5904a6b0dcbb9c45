"""Word-shingle sets of a batch of texts as 64-bit hashes, in whole arrays.

Words are runs of bytes other than ASCII white space, ASCII letters in lower
case.  A word's hash is a sum of byte times a pseudo-random multiplier of the
byte's place, mixed; a shingle's hash mixes its words' hashes in order.
Nothing is done per word in Python, so hashing again is cheaper than keeping
the hashes on disk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_GOLD = 0x9E3779B97F4A7C15
_PLACES = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose bits all depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(first: int, n: int) -> np.ndarray:
    """``n`` odd pseudo-random 64-bit numbers, the same for ever."""
    return mix((np.arange(first, first + n, dtype=np.uint64) + np.uint64(1)) * np.uint64(_GOLD)) | np.uint64(1)


_BY_PLACE = seeds(0, _PLACES)


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and each one's bounds."""
    column = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not offsets.size:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, bounds of each text's words among them)."""
    data, offsets = _bytes_of(texts)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = inside[firsts]  # a word ends with its text
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, offsets)
    if not starts.size:
        return np.zeros(0, np.uint64), bounds
    place = _places(data.size, starts)
    factor = _BY_PLACE[place & (_PLACES - 1)]
    if int(place.max()) >= _PLACES:
        factor = factor * seeds(_PLACES, int(place.max()) // _PLACES + 1)[place // _PLACES]
    values = (_LOWER[data].astype(np.uint64) + np.uint64(1)) * factor
    values[~inside] = 0
    return mix(np.add.reduceat(values, starts)), bounds


def _places(size: int, starts: np.ndarray) -> np.ndarray:
    """Each byte's place in its word; 0 before the first word."""
    place = np.arange(size)
    lengths = np.diff(np.append(starts, size))
    place[starts[0] :] -= np.repeat(starts, lengths)
    place[: starts[0]] = 0
    return place


def shingle_sets(texts: pa.Array, size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text in ascending order, one text
    after the other; bounds of each text's).  A text with fewer words than
    ``size`` has its whole sequence as the only shingle; null, or no word:
    none."""
    words, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    factors = seeds(2 * _PLACES, size + 1)
    made = np.zeros(words.size, np.uint64)
    left = np.repeat(bounds[1:], counts) - np.arange(words.size)  # words from here to the text's end
    for i in range(size):
        there = np.flatnonzero(left > i)
        made[there] += words[there + i] * factors[i]
    short = np.repeat(counts < size, counts)
    made[short] += np.repeat(counts, counts)[short].astype(np.uint64) * factors[size]
    keep = np.where(short, left == np.repeat(counts, counts), left >= size)
    made = mix(made[keep])
    ends = np.cumsum(np.where(counts < size, counts > 0, counts - size + 1))
    ends = np.concatenate(([0], ends))
    for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
        made[a:z].sort()
    fresh = np.ones(made.size, bool)
    fresh[1:] = made[1:] != made[:-1]
    fresh[ends[:-1][np.diff(ends) > 0]] = True
    return made[fresh], np.concatenate(([0], np.cumsum(fresh)))[ends]
