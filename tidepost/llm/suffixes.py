"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified as smaller or larger than their successor. Leftmost-smaller substrings are
sorted by induction from their first letters and named; the string of names is sorted in the same way
until all names differ; then the whole array is induced from the sorted ones. A letter's bucket is
induced at a time: what its suffixes induce in other buckets is appended to those in one step, and runs of
a letter are followed step by step within the bucket. So that there are few letters on every level, a
name is spelt with two digits; a short string of names is induced one by one instead.
"""

from __future__ import annotations

import numpy as np

#: Letters below those of the text: end of everything, and end of a string.
END, BREAK = 0, 1
#: Strings of at most so many names are induced one by one.
SHORT = 1 << 16


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all strings, each followed by ``BREAK`` and the last by ``END``, and where each begins."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes + np.arange(len(strings))
    text = np.full(len(data) + len(strings) + 1, BREAK, np.uint16)
    text[-1] = END
    text[np.arange(len(data)) + np.repeat(np.arange(len(strings)), sizes)] = (
        data.astype(np.uint16) + np.uint16(2)
    )
    return text, begins


def smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last, ``END``, counts as smaller."""
    count = len(text)
    step = np.zeros(count, np.int8)
    step[:-1] = np.sign(np.diff(text.astype(np.int32)))
    step[-1] = 1
    # an equal letter takes the sign of the next change
    changes = np.flatnonzero(step)
    return step[changes[np.searchsorted(changes, np.arange(count))]] > 0


class _Buckets:
    """Places of each letter's suffixes: larger ones first, then smaller ones."""

    def __init__(self, text: np.ndarray, small: np.ndarray):
        letters = int(text.max()) + 1
        self.count = np.bincount(text, minlength=letters)
        self.start = np.cumsum(self.count) - self.count
        self.end = self.start + self.count
        self.large = np.bincount(text[~small], minlength=letters)
        self.present = np.flatnonzero(self.count).tolist()


def _grouped(places: np.ndarray, letters: np.ndarray, size: int):
    """Places sorted by letter, keeping their order, with the number among their letter's."""
    order = np.argsort(letters, kind="stable")
    letters = letters[order]
    counts = np.bincount(letters, minlength=size)
    before = np.cumsum(counts) - counts
    return places[order], letters, np.arange(len(order)) - before[letters], counts


def induced(text: np.ndarray, buckets: _Buckets, seeds: np.ndarray) -> np.ndarray:
    """All suffixes, induced from ``seeds``: leftmost-smaller places in their order."""
    size = len(buckets.count)
    out = np.empty(len(text), np.int64)
    seeded, letters, _, counts = _grouped(seeds, text[seeds], size)
    stop = np.cumsum(counts)
    head = buckets.start.copy()
    for c in buckets.present:
        first, low, high = int(buckets.start[c]), int(buckets.start[c]), int(head[c])
        while low < high:
            before = out[low:high] - 1
            before = before[text[before] == c]
            low = high
            high += len(before)
            out[low:high] = before
        before = np.concatenate([out[first:high], seeded[stop[c] - counts[c] : stop[c]]]) - 1
        letters = text[before]
        up = letters > c
        before, letters, number, more = _grouped(before[up], letters[up], size)
        out[head[letters] + number] = before
        head += more
    tail = buckets.end.copy()
    for c in reversed(buckets.present):
        if c == END:
            out[0] = len(text) - 1
            continue
        low, high = int(tail[c]), int(buckets.end[c])
        last = high
        while low < high:
            before = out[low:high][::-1] - 1
            before = before[text[before] == c]
            high = low
            low -= len(before)
            out[low:high] = before[::-1]
        first = int(buckets.start[c])
        large = out[first : first + int(buckets.large[c])]
        before = np.concatenate([out[low:last][::-1], large[::-1]]) - 1
        before = before[before >= 0]
        letters = text[before]
        down = letters < c
        before, letters, number, more = _grouped(before[down], letters[down], size)
        out[tail[letters] - 1 - number] = before
        tail -= more
    return out


def _names(text: np.ndarray, places: np.ndarray, order: np.ndarray, strings: bool) -> np.ndarray:
    """Names of the substrings from one of ``places`` to the next, by place; equal ones share one.

    In a text of ``strings``, those that begin with ``BREAK`` differ from each other.
    """
    size = np.zeros(len(text), np.int64)
    size[places[:-1]] = np.diff(places) + 1
    size[places[-1]] = 1
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    if strings:
        same &= text[a] != BREAK
    live, at = np.flatnonzero(same), 0
    while len(live):
        equal = text[a[live] + at] == text[b[live] + at]
        same[live[~equal]] = False
        at += 1
        live = live[equal]
        live = live[size[a[live]] > at]
    name = np.zeros(len(text), np.int64)
    name[order] = np.concatenate([[0], np.cumsum(~same)])
    return name[places]


def suffix_array(text: np.ndarray, strings: bool = False) -> np.ndarray:
    """Places of all suffixes of ``text`` (whose last letter is the only ``END``) in order.

    With ``strings`` (see ``joined``), suffixes are compared up to the end of their string, and those
    that are equal so far have any order.
    """
    small = smaller(text)
    buckets = _Buckets(text, small)
    left = small.copy()
    left[1:] &= ~small[:-1]
    left[0] = False
    places = np.flatnonzero(left)
    if not len(places):
        return np.array([0], np.int64)
    order = induced(text, buckets, places)
    order = order[left[order]]
    names = _names(text, places, order, strings)
    if names.max() + 1 < len(names):
        order = places[sorted_names(names)]
    return induced(text, buckets, order)


def sorted_names(names: np.ndarray) -> np.ndarray:
    """The suffix array of a string of names, whose last one, 0, occurs once."""
    if len(names) <= SHORT:
        return np.array(induced_names(names.tolist(), int(names.max()) + 1))
    base = int(np.ceil(np.sqrt(names.max() + 1)))
    spelt = np.empty(2 * len(names) - 1, np.uint32 if base >= 2**16 else np.uint16)
    spelt[:-1:2], spelt[1::2] = names[:-1] // base + 1, names[:-1] % base + 1
    spelt[-1] = END
    order = suffix_array(spelt)
    return order[order % 2 == 0] // 2


def induced_names(text: list[int], size: int) -> list[int]:
    """The suffix array of names below ``size``, whose last one, 0, occurs once."""
    count = len(text)
    small = bytearray(count)
    small[-1] = 1
    for i in range(count - 2, -1, -1):
        a, b = text[i], text[i + 1]
        small[i] = a < b or (a == b and small[i + 1])
    places = [i for i in range(1, count) if small[i] and not small[i - 1]]
    total = [0] * (size + 1)
    for c in text:
        total[c + 1] += 1
    for c in range(size):
        total[c + 1] += total[c]

    def induce(seeds: list[int]) -> list[int]:
        out = [-1] * count
        tail = total[1:]
        for i in reversed(seeds):
            c = text[i]
            tail[c] -= 1
            out[tail[c]] = i
        head = total[:-1]
        for i in out:
            if i > 0 and not small[i - 1]:
                c = text[i - 1]
                out[head[c]] = i - 1
                head[c] += 1
        tail = total[1:]
        for k in range(count - 1, -1, -1):
            i = out[k]
            if i > 0 and small[i - 1]:
                c = text[i - 1]
                tail[c] -= 1
                out[tail[c]] = i - 1
        return out

    if not places:
        return [0]
    end = {a: b for a, b in zip(places, places[1:], strict=False)}
    name, last, names = -1, None, {}
    for i in induce(places):
        if i > 0 and small[i] and not small[i - 1]:
            part = text[i : end[i] + 1] if i in end else text[i:]
            if part != last:
                name, last = name + 1, part
            names[i] = name
    if name + 1 < len(places):
        shorter = induced_names([names[i] for i in places], name + 1)
    else:
        shorter = [0] * len(places)
        for k, i in enumerate(places):
            shorter[names[i]] = k
    return induce([places[k] for k in shorter])


def common_prefixes(
    text: np.ndarray, order: np.ndarray, begins: np.ndarray, longest: int
) -> np.ndarray:
    """By place: how many letters a suffix shares with the one before it in ``order``.

    Counted where the letters before the two suffixes differ, and where a string begins, up to
    ``longest``, the length of the longest string. From there on, the number falls by one at every place.
    Numbers that end within a string are exact.
    """
    count = len(text)
    before = np.empty(count, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = order[0]
    place = np.arange(count)
    told = np.zeros(count, dtype=bool)
    told[1:] = (text[:-1] == text[before[1:] - 1]) & (before[1:] > 0)
    told[begins] = False
    told[order[0]] = False
    starts = place[~told]
    shared = np.zeros(len(starts), np.int64)
    room = longest + 8
    padded = np.concatenate([text, np.zeros(room + 4, np.uint16)])
    four = np.lib.stride_tricks.as_strided(
        padded.view(np.uint8), (len(padded) - 3, 8), (2, 1)
    )
    live = np.arange(len(starts))
    words = np.ascontiguousarray(four).view(np.uint64).ravel()
    while len(live):
        a = starts[live] + shared[live]
        b = before[starts[live]] + shared[live]
        # a suffix may reach the end of the text, beyond which nothing is shared
        equal = (np.maximum(a, b) + 4 <= count) & (words[np.minimum(a, count - 1)] == words[np.minimum(b, count - 1)])
        live = live[equal]
        shared[live] += 4
        live = live[shared[live] < longest]
    live = np.arange(len(starts))
    for _ in range(3):
        a = starts[live] + shared[live]
        b = before[starts[live]] + shared[live]
        equal = (np.maximum(a, b) < count) & (padded[a] == padded[b])
        live = live[equal]
        shared[live] += 1
    shared[starts == order[0]] = 0
    out = np.zeros(count, np.int64)
    out[starts] = starts + shared
    # the number at a place follows from the last place before it that was counted
    since = np.maximum.accumulate(np.where(told, -1, place))
    return np.maximum(out[since] - place, 0)


def repeated_places(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, the places whose next ``length`` bytes occur at another place of any string."""
    text, begins = joined(strings)
    order = suffix_array(text, strings=True)
    longest = max(map(len, strings), default=0)
    shared = common_prefixes(text, order, begins, max(longest, length))
    after = np.zeros(len(text), np.int64)
    after[order[:-1]] = shared[order[1:]]
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    repeated = np.maximum(shared, after) >= length
    return [
        np.flatnonzero(repeated[b : b + max(0, n - length + 1)])
        for b, n in zip(begins.tolist(), sizes.tolist(), strict=True)
    ]
