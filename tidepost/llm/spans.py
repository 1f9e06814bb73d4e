"""Words and word runs of many texts at once: vectorised hashing of UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_WORD = 2**64
_RUN = np.uint64(0xD1342543DE82EF95)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < count:
        size = max(count, 1 << 16)
        for i, base in enumerate((_MULTIPLIER, pow(_MULTIPLIER, -1, _WORD))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors)
    return _powers[0][:count], _powers[1][:count]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins and ends; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about ``limit`` bytes; a longer text is a part."""
    sizes = np.diff(utf8(batch.column(text))[1])
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < len(sizes):
        yield batch.slice(start)


class Words:
    """Words (runs of bytes that are not white space) of all texts: place, text and hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        white = _WHITE[data]
        count = len(data)
        edge = np.zeros(count + 1, dtype=bool)
        edge[offsets] = True
        before = np.ones(count, dtype=bool)
        before[1:] = white[:-1]
        after = np.ones(count, dtype=bool)
        after[:-1] = white[1:]
        self.start = np.flatnonzero(~white & (before | edge[:-1]))
        self.end = np.flatnonzero(~white & (after | edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        up, down = powers(count + 1)
        values = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
        sums = np.zeros(count + 1, np.uint64)
        np.cumsum(values * up[:-1], out=sums[1:])
        self.hash = mixed((sums[self.end] - sums[self.start]) * down[self.start])


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` hashes, by its first place."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * _RUN + hashes[i : i + count]
    return mixed(total + np.uint64(size))


def shingle_sets(
    column: pa.Array, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the word shingles of every text, and where each text's begin.

    A text of fewer words has one shingle, its whole sequence; a text without words has none.
    """
    data, offsets = utf8(column)
    words = Words(data, offsets, lower=True)
    texts = len(offsets) - 1
    begin = np.searchsorted(words.doc, np.arange(texts + 1))
    whole = runs(words.hash, size)
    sets = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            sets.append(runs(words.hash[a:b], b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    bounds = np.zeros(texts + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=bounds[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), bounds
