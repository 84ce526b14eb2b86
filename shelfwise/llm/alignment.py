"""Banded alignment: is the edit distance of two word sequences within a limit?

Cheap answers come first: equal places, and words that only one side has.  Then
the band of diagonals that the limit allows moves along the sequences, one bit
a diagonal (the bit-vector algorithm of Myers and Hyyro on Python integers).
Very long sequences keep the furthest position on each diagonal for every number
of edits instead, which needs memory for the band only."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from operator import ne

import numpy as np

#: Words up to which every word's places are one integer.
BIT_WORDS = 30_000


def within(a: Sequence, b: Sequence, limit: int) -> bool:
    """Whether insertions, deletions and substitutions, at most ``limit``
    together, turn ``a`` into ``b`` (lists of hashable items)."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return False
    if len(a) <= limit or (len(a) == len(b) and sum(map(ne, a, b)) <= limit):
        return True
    start, end = 0, len(b)
    while start < end and a[start] == b[start]:
        start += 1
    more = len(a) - len(b)
    while end > start and a[end + more - 1] == b[end - 1]:
        end -= 1
    a, b = a[start:end + more], b[start:end]
    if len(a) <= limit:
        return True
    if not len(b):
        return False
    surplus = Counter(a)
    surplus.subtract(b)                               # words that one side lacks need an edit each
    if max(sum(n for n in surplus.values() if n > 0), -sum(n for n in surplus.values() if n < 0)) > limit:
        return False
    if len(a) <= BIT_WORDS:
        return _band(a, b, limit)
    number: dict = {}
    x = np.array([number.setdefault(w, len(number)) for w in a], np.int64)
    y = np.array([number.setdefault(w, len(number)) for w in b], np.int64)
    return _reaches(x, y, limit)


def _band(a: Sequence, b: Sequence, limit: int) -> bool:
    """``a`` is the longer one, by at most ``limit``, and longer than that."""
    n, m = len(a), len(b)
    places: dict = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | (1 << i)
    width = 2 * limit + 1
    full = (1 << width) - 1
    rises, falls = full & (full << limit), 0          # vertical differences within the band
    distance, diagonal, most = limit, 1 << (width - 1), 2 * limit + m - n
    edge = diagonal
    for i in range(m):
        at = i - limit
        here = places.get(b[i], 0)
        here = (here << -at if at < 0 else here >> at) & full
        free = ((((here & rises) + rises) ^ rises) | here | falls) & full
        across_up = (falls | ~(free | rises)) & full
        across_down = free & rises
        if i < n - limit:
            distance += not free & diagonal           # along the band's lowest diagonal
        else:                                         # along the last row
            edge >>= 1
            distance += bool(across_up & edge)
            distance -= bool(across_down & edge)
        if distance > most:
            return False
        free >>= 1
        rises = (across_down | ~(free | across_up)) & full
        falls = free & across_up
    return distance <= limit


def _reaches(a: np.ndarray, b: np.ndarray, limit: int) -> bool:
    n, m = len(a), len(b)
    goal = m - n                                      # diagonal of the last cell
    gone = -(n + m + 2)
    reach = np.full(2 * limit + 3, gone, np.int64)    # by diagonal + limit + 1
    reach[limit + 1] = 0
    _slide(a, b, reach, np.array([0]), limit)
    if reach[goal + limit + 1] >= n:
        return True
    for edits in range(1, limit + 1):
        left = limit - edits
        low, high = max(-edits, goal - left), min(edits, goal + left)
        if low > high:
            return False
        k = np.arange(low, high + 1)
        at = k + limit + 1
        best = np.maximum(np.maximum(reach[at] + 1, reach[at + 1] + 1), reach[at - 1])
        reach[at] = np.minimum(np.minimum(best, n), m - k)
        _slide(a, b, reach, k, limit)
        if low <= goal <= high and reach[goal + limit + 1] >= n:
            return True
    return False


def _slide(a: np.ndarray, b: np.ndarray, reach: np.ndarray, k: np.ndarray, limit: int) -> None:
    """Move every diagonal's position on over equal words."""
    n, m = len(a), len(b)
    k = k[reach[k + limit + 1] >= np.maximum(0, -k)]
    for _ in range(6):
        i = reach[k + limit + 1]
        k = k[(i < n) & (i + k < m)]
        if not len(k):
            return
        i = reach[k + limit + 1]
        k = k[a[i] == b[i + k]]
        if not len(k):
            return
        reach[k + limit + 1] += 1
    for d in k.tolist():                              # long runs, on few diagonals
        i = int(reach[d + limit + 1])
        step = 64
        while i < n and i + d < m:
            size = min(step, n - i, m - i - d)
            differ = np.flatnonzero(a[i:i + size] != b[i + d:i + d + size])
            if len(differ):
                i += int(differ[0])
                break
            i += size
            step *= 4
        reach[d + limit + 1] = i
