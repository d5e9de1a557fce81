"""Longest common subsequences of two lists in memory linear in their lengths.

Items that the other list lacks are dropped first, and common heads and tails are taken off. Where matching pairs are few, the
chain of matches is kept link by link (Hunt and Szymanski 1977). Elsewhere rows of the length table are bit vectors in one
integer each (Crochemore et al. 2001, Hyyro 2004), which takes n * m / 64 machine steps, and the sequence is found by
divide and conquer (Hirschberg 1975), so that no more than TABLE bits of rows are ever held. A list of 20,000 equal
items against another takes a fraction of a second.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Hashable, Sequence

import numpy as np

#: Matching pairs per item up to which links are kept, and bits of rows held at once.
PAIRS, TABLE = 4, 1 << 25


def _links(own: list[int], other: list[int]) -> list[int]:
    """Indices of ``own`` in a longest common subsequence; memory grows with the matching pairs."""
    places: dict[int, list[int]] = {}
    for j in range(len(other) - 1, -1, -1):
        places.setdefault(other[j], []).append(j)
    ends: list[int] = []  # smallest last index in ``other`` of a common subsequence of each length
    links: list[tuple] = []
    for i, x in enumerate(own):
        for j in places.get(x, ()):
            k = bisect.bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    found = []
    link = links[-1] if links else None
    while link:
        found.append(link[0])
        link = link[1]
    return found[::-1]


class _Masks:
    """By item the bits of its places in a list. Those of items with many places are kept, the others made when asked for."""

    def __init__(self, items: list[int]):
        self.bytes = (len(items) + 7) // 8
        self.places: dict[int, list[int]] = {}
        for j, x in enumerate(items):
            self.places.setdefault(x, []).append(j)
        self.many = max(8, int(len(items) ** 0.5))
        self.kept: dict[int, int] = {}

    def of(self, x: int) -> int:
        if (mask := self.kept.get(x)) is None:
            bits = bytearray(self.bytes)
            for j in self.places.get(x, ()):
                bits[j >> 3] |= 1 << (j & 7)
            mask = int.from_bytes(bits, "little")
            if len(self.places.get(x, ())) > self.many:
                self.kept[x] = mask
        return mask


def _rows(own: Sequence[int], other: list[int]):
    """After each item of ``own`` the row of the table: bit j is 0 where other[j] adds one to the length."""
    masks, full = _Masks(other), (1 << len(other)) - 1
    row = full
    for x in own:
        hit = row & masks.of(x)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(own: Sequence[int], other: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``own`` with each beginning of ``other``, the empty one first."""
    row = (1 << len(other)) - 1
    for row in _rows(own, other):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes((len(other) + 7) // 8, "little"), np.uint8), bitorder="little")[: len(other)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _table(own: list[int], other: list[int]) -> list[int]:
    """Indices of ``own`` in a longest common subsequence, traced back over all rows."""
    size = (len(other) + 7) // 8
    rows = [row.to_bytes(size, "little") for row in _rows(own, other)]
    found, i, j = [], len(own), len(other)
    while i and j:
        at, bit = (j - 1) >> 3, 1 << ((j - 1) & 7)
        if rows[i - 1][at] & bit:
            j -= 1
        elif i > 1 and not rows[i - 2][at] & bit:
            i -= 1
        else:
            i, j = i - 1, j - 1
            found.append(i)
    return found[::-1]


def _common(own: list[int], other: list[int]) -> list[int]:
    found: list[int] = []
    todo = [(0, len(own), 0, len(other))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a == 1 or (b - a) * (d - c) <= TABLE:
            found += [a + i for i in _table(own[a:b], other[c:d])]
            continue
        half = (a + b) // 2
        part = other[c:d]
        total = _lengths(own[a:half], part) + _lengths(own[half:b][::-1], part[::-1])[::-1]
        at = c + int(total.argmax())
        todo += [(a, half, c, at), (half, b, at, d)]
    return found


def shared(own: Sequence[Hashable], other: Sequence[Hashable]) -> set[int]:
    """Indices of ``own`` in a longest common subsequence of both."""
    n, m, head = len(own), len(other), 0
    while head < min(n, m) and own[head] == other[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and own[n - 1 - tail] == other[m - 1 - tail]:
        tail += 1
    found = {*range(head), *range(n - tail, n)}
    left, right = Counter(own[head : n - tail]), Counter(other[head : m - tail])
    numbers = {x: k for k, x in enumerate(left.keys() & right.keys())}
    kept = [i for i in range(head, n - tail) if own[i] in numbers]
    if not kept:
        return found
    a = [numbers[own[i]] for i in kept]
    b = [numbers[x] for x in other[head : m - tail] if x in numbers]
    pairs = sum(left[x] * right[x] for x in numbers)
    few = pairs <= PAIRS * (len(a) + len(b))
    return found.union(kept[i] for i in (_links(a, b) if few else _common(a, b)))
