"""Ratcliff/Obershelp matching of two word sequences: the totals of difflib, in both directions at once.

The longest block that both have is taken, of equally long ones the first in the leading sequence, then in the other; what stands
before it in both and what stands after it in both go on alone. Blocks are looked up among the maximal runs of equal words, clipped to
the part at hand; parts with too many runs to hold find their longest block by ranks of spans whose lengths are powers of two.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np

HELD = 2_000_000  # equal places of two parts that are held at once, at most


def _numbers(x: list[str], y: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words that both have by number, others of x as -1, of y as -2."""
    ids = {w: k for k, w in enumerate(set(x) & set(y))}
    return np.fromiter(map(ids.get, x, repeat(-1)), np.int64, len(x)), np.fromiter(map(ids.get, y, repeat(-2)), np.int64, len(y))


def _counts(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = max(int(x.max()), int(y.max()), 0) + 1
    return np.bincount(x[x >= 0], minlength=size), np.bincount(y[y >= 0], minlength=size)


def _runs(x: np.ndarray, y: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in x, start in y and length of every maximal run of equal words; often counts the words of y."""
    at, order = np.flatnonzero(x >= 0), np.flatnonzero(y >= 0)
    order = order[np.argsort(y[order], kind="stable")]
    counts, first = often[x[at]], (np.cumsum(often) - often)[x[at]]
    i = np.repeat(at, counts)
    j = order[np.arange(len(i)) + np.repeat(first - np.cumsum(counts) + counts, counts)]
    # differing guards on both sides
    before, behind = np.concatenate(([-3], x)), np.concatenate((x, [-3]))
    begins, ends = before[i] != np.concatenate(([-4], y))[j], behind[i + 1] != np.concatenate((y, [-4]))[j + 1]
    diagonal = (i - j + len(y)) * (len(x) + 1) + i
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    start, end = start[np.argsort(diagonal[start])], end[np.argsort(diagonal[end])]  # both by diagonal: one end for each start
    return i[start], j[start], i[end] - i[start] + 1


class _Ranks:
    """Which spans of both sequences are equal, for any length."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cut = len(x) + 1
        both = np.concatenate((x, [-3], y, [-4]))
        self.of = [np.unique(both, return_inverse=True)[1]]
        while 2 << (len(self.of) - 1) <= min(len(x), len(y)):
            self.of.append(self._keys(2 << (len(self.of) - 1), np.arange(len(both) - (2 << (len(self.of) - 1)) + 1), True))

    def _keys(self, size: int, at: np.ndarray, small: bool = False) -> np.ndarray:
        k = size.bit_length() - 1
        k = k if k < len(self.of) else k - 1
        own = self.of[k]
        keys = own[at] * (len(self.of[0]) + 1) + own[at + size - (1 << k)]
        return np.unique(keys, return_inverse=True)[1] if small else keys

    def longest(self, part: tuple[int, int, int, int], swap: bool) -> tuple[int, int, int]:
        a, b, c, d = part
        spans = lambda n: (self._keys(n, np.arange(a, b - n + 1)), self._keys(n, np.arange(self.cut + c, self.cut + d - n + 1)))
        low, high = 0, min(b - a, d - c)
        while low < high:
            n = (low + high + 1) // 2
            if np.isin(*spans(n)).any():
                low = n
            else:
                high = n - 1
        if not low:
            return 0, 0, 0
        x, y = spans(low)
        if swap:
            j = int(np.isin(y, x).argmax())
            return a + int((x == y[j]).argmax()), c + j, low
        i = int(np.isin(x, y).argmax())
        return a + i, c + int((y == x[i]).argmax()), low


def _single(i: np.ndarray, j: np.ndarray, swap: bool) -> int:
    """Words matched where no run has two: the first one that stands after the last match in both, again and again."""
    lead, other = (j, i) if swap else (i, j)
    order = np.lexsort((other, lead))
    count, p, q = 0, -1, -1
    for a, b in zip(lead[order].tolist(), other[order].tolist(), strict=True):
        if a > p and b > q:
            count, p, q = count + 1, a, b
    return count


def _by_runs(i: np.ndarray, j: np.ndarray, n: np.ndarray, ways: tuple[int, ...], total: list[int]) -> None:
    """Adds what is matched in each of the ways (0: the first sequence leads, 1: the second) among the runs of a part."""
    stack = [(i, j, n, ways)]
    while stack:
        i, j, n, ways = stack.pop()
        if not len(n):
            continue
        top = int(n.max())
        if top == 1:
            for w in ways:
                total[w] += _single(i, j, bool(w))
            continue
        best = np.flatnonzero(n == top)
        p, q = i[best], j[best]
        picks = {w: int(best[0] if len(best) == 1 else best[np.lexsort((p, q) if w else (q, p))[0]]) for w in ways}
        if len(set(picks.values())) > 1:
            stack += [(i, j, n, (w,)) for w in ways]
            continue
        pick = picks[ways[0]]
        a, b = int(i[pick]), int(j[pick])
        for w in ways:
            total[w] += top
        left = np.minimum(n, np.minimum(a - i, b - j))
        keep = left > 0
        stack.append((i[keep], j[keep], left[keep], ways))
        gone = np.maximum(0, np.maximum(a + top - i, b + top - j))
        keep = gone < n
        gone = gone[keep]
        stack.append((i[keep] + gone, j[keep] + gone, n[keep] - gone, ways))


def matched(x: list[str], y: list[str], held: int = HELD) -> tuple[int, int]:
    """Words in matching blocks of x and y, and of y and x: which sequence leads decides among equally long blocks."""
    if x == y:
        return len(x), len(x)
    own, other = _numbers(x, y)
    total, ranks = [0, 0], None
    stack = [(0, len(x), 0, len(y), (0, 1))]
    while stack:
        *part, ways = stack.pop()
        a, b, c, d = part
        if a >= b or c >= d:
            continue
        one, two = own[a:b], other[c:d]
        often = _counts(one, two)
        if int(often[0] @ often[1]) <= held:
            _by_runs(*_runs(one, two, often[1]), ways, total)
            continue
        ranks = ranks or _Ranks(own, other)
        found = {w: ranks.longest((a, b, c, d), bool(w)) for w in ways}
        if len(set(found.values())) > 1:
            stack += [(a, b, c, d, (w,)) for w in ways]
            continue
        i, j, n = found[ways[0]]
        for w in ways:
            total[w] += n
        if n:
            stack += [(a, i, c, j, ways), (i + n, b, j + n, d, ways)]
    return total[0], total[1]
