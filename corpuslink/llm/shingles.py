"""Word shingles of whole texts as 64-bit hashes, many documents at a time (numpy).

Words: runs of bytes other than the space and 0x09 to 0x0D, with A-Z in lower case. A
document's shingles are its distinct runs of ``width`` words; with fewer words, the whole
sequence is its one shingle; without words it has none. The hash of a word is a sum of its
bytes times fixed random numbers by place; a shingle's is one of its words' hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WIDTH = 5
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit integers (one to one)."""
    x = np.atleast_1d(np.asarray(x, np.uint64))          # scalars would warn of overflow
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(n: int, salt: int) -> np.ndarray:
    """``n`` fixed random odd 64-bit integers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.uint64(salt)) | np.uint64(1)


_PLACES = _numbers(4096, 1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of each document); null has none."""
    global _PLACES
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else \
        np.zeros(0, np.uint8)
    ends = ends - ends[0]
    blank = _BLANK[raw]
    inside = ~blank
    new = inside.copy()
    new[1:] &= blank[:-1]
    edges = ends[:-1][ends[:-1] < len(raw)]
    new[edges] = inside[edges]
    starts = np.flatnonzero(new)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    number = np.searchsorted(starts, ends)
    kept = np.flatnonzero(inside)
    letters = _LOWER[raw[kept]].astype(np.uint64) + np.uint64(1)
    first = np.searchsorted(kept, starts)
    size = np.diff(np.append(first, len(kept)))
    longest = int(size.max())
    if longest > len(_PLACES):
        _PLACES = _numbers(longest, 1)
    place = np.arange(len(kept)) - np.repeat(first, size)
    letters *= _PLACES[place]
    return mix(np.add.reduceat(letters, first)), np.diff(number)


_STEPS = _numbers(WIDTH + 1, 2)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all documents, ascending within each; how many each has)."""
    words, number = word_hashes(texts)
    n = len(number)
    ends = np.cumsum(number)
    doc = np.repeat(np.arange(n), number)
    made, owner = [], []
    if len(words) >= WIDTH:
        last = len(words) - WIDTH + 1
        sums = words[:last] * _STEPS[0]
        for k in range(1, WIDTH):
            sums += words[k:k + last] * _STEPS[k]
        whole = doc[:last] == doc[WIDTH - 1:]
        made.append(mix(sums[whole]))
        owner.append(doc[:last][whole])
    short = np.flatnonzero((number > 0) & (number < WIDTH))
    if len(short):
        sums = number[short].astype(np.uint64) * _STEPS[WIDTH]
        for k in range(WIDTH - 1):
            has = number[short] > k
            sums[has] += words[(ends - number)[short[has]] + k] * _STEPS[k]
        made.append(mix(sums))
        owner.append(short)
    if not made:
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    values, owner = np.concatenate(made), np.concatenate(owner)
    order = np.argsort(values)
    order = order[np.argsort(owner[order].astype(np.uint16 if n < 65536 else np.int64),
                             kind="stable")]
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[fresh], np.bincount(owner[fresh], minlength=n)
