"""Alignment of two texts by their longest common blocks.

The longest block that both texts hold is taken (the earliest in the first text, then in the second), then
what lies before and after it is aligned in the same way. How long the block is, is found by bisection: with the
running hash of a text all its windows of one length are hashed at once, and the lengths that both texts share
a window of have no gap. A match of hashes is checked letter by letter. Small remainders are compared directly.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
SMALL = 4096  # cells of a table that is filled directly


class _Text:
    """Code points and their running hash, weighted so that a window's hash does not depend on its place."""

    def __init__(self, text: str):
        self.points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        x = (self.points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        self.weight = np.cumprod(np.full(len(x) + 1, BASE), dtype=np.uint64)
        self.run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * self.weight[:-1], dtype=np.uint64)))

    def windows(self, lo: int, hi: int, n: int, top: np.ndarray) -> np.ndarray:
        """Hashes of the windows of n from lo to hi; top: weights in falling order, as long as the longer text."""
        at = np.arange(lo, hi - n + 1)
        return (self.run[at + n] - self.run[at]) * top[at]


def _direct(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(start in a, start in b, length) of the longest common block, by the table of all pairs."""
    best, row = (0, 0, 0), np.zeros(len(b) + 1, np.int64)
    for i, x in enumerate(a):
        new = np.zeros(len(b) + 1, np.int64)
        hit = np.flatnonzero(b == x)
        new[hit + 1] = row[hit] + 1
        n = int(new.max())
        if n > best[2]:
            best = (i - n + 1, int(np.flatnonzero(new == n)[0]) - n, n)
        row = new
    return best


def _longest(a: _Text, b: _Text, alo: int, ahi: int, blo: int, bhi: int, top: np.ndarray) -> tuple[int, int, int]:
    if (ahi - alo) * (bhi - blo) <= SMALL:
        i, j, n = _direct(a.points[alo:ahi], b.points[blo:bhi])
        return alo + i, blo + j, n

    def at(n: int) -> tuple[int, int] | None:
        """The first window of n in a that b has, and its first place there."""
        x, y = a.windows(alo, ahi, n, top), b.windows(blo, bhi, n, top)
        ys, first = np.unique(y, return_index=True)
        k = np.minimum(np.searchsorted(ys, x), len(ys) - 1)
        for i in np.flatnonzero(ys[k] == x):
            j = int(first[k[i]])
            if (a.points[alo + i : alo + i + n] == b.points[blo + j : blo + j + n]).all():
                return alo + int(i), blo + j
        return None

    found, low, high = None, 0, min(ahi - alo, bhi - blo)
    while low < high:
        n = (low + high + 1) // 2
        hit = at(n)
        if hit:
            found, low = hit, n
        else:
            high = n - 1
    return (*found, low) if found else (alo, blo, 0)


def blocks(before: str, after: str) -> list[tuple[int, int, int]]:
    """(start in before, start in after, length) of the blocks that stay, in order; neighbours are joined."""
    a, b = _Text(before), _Text(after)
    top = max(a.weight, b.weight, key=len)[::-1]
    out, todo = [], [(0, len(a.points), 0, len(b.points))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        if alo >= ahi or blo >= bhi:
            continue
        i, j, n = _longest(a, b, alo, ahi, blo, bhi, top)
        if n:
            out.append((i, j, n))
            todo += [(alo, i, blo, j), (i + n, ahi, j + n, bhi)]
    joined: list[list[int]] = []
    for i, j, n in sorted(out):
        if joined and joined[-1][0] + joined[-1][2] == i and joined[-1][1] + joined[-1][2] == j:
            joined[-1][2] += n
        else:
            joined.append([i, j, n])
    return [tuple(x) for x in joined]


def changes(before: str, after: str) -> list[tuple[int, int, int, int]]:
    """(from, to) in before and in after of every stretch that differs, in order."""
    out, i, j = [], 0, 0
    for a, b, n in [*blocks(before, after), (len(before), len(after), 0)]:
        if i < a or j < b:
            out.append((i, a, j, b))
        i, j = a + n, b + n
    return out


def shown(before: str, after: str, context: int) -> str:
    """What moved: removals as [-old-], additions as {+new+}, some characters around, … for what is left out."""
    out, told = "", 0
    for a, b, c, d in changes(before, after):
        lead = max(told, a - context)
        out += "…" * (a - context > told) + before[lead:a]
        out += f"[-{before[a:b]}-]" * (b > a) + f"{{+{after[c:d]}+}}" * (d > c)
        told = b + context
        out += before[b:told] + "…" * (told < len(before))
    return out
