"""Word-shingle sets of whole texts, many texts at a time in numpy.

Words are the runs of bytes other than 0x20 and 0x09-0x0D of the text with A-Z lower-cased. A word's
hash is a polynomial over its bytes, cut from one running sum over the whole slice; a shingle's hash is
a sum over its words' hashes. Both are 64 bits wide and mixed.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(7_2024)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    if len(_powers.get(base, ())) < n:
        p = np.full(max(n, 1 << 20), np.uint64(base))
        p[0] = 1
        _powers[base] = np.cumprod(p, dtype=np.uint64)
    return _powers[base][:n]


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes): the distinct shingle hashes of text i, ascending, are hashes[starts[i]:starts[i+1]].
    A text of fewer words than width has its whole sequence as one shingle; without words, none."""
    data = [t.encode() for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data])
    b = np.frombuffer(b"\n".join([*data, b""]).lower(), np.uint8)
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    first, after = edge[0::2], edge[1::2]
    n_words = np.diff(np.searchsorted(first, np.concatenate(([0], ends))))
    if not len(first):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint64)
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * _power(_BASE, len(b)), dtype=np.uint64)))
    words = mix((run[after] - run[first]) * _power(_INVERSE, len(b))[first] + (after - first).astype(np.uint64))
    text_of = np.repeat(np.arange(len(texts)), n_words)
    whole = n_words >= width
    n = len(words)
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h[: max(0, n - i)] += words[i:] * _WORD[i]
    inside = np.zeros(n, bool)
    if n >= width:
        inside[: n - width + 1] = text_of[: n - width + 1] == text_of[width - 1 :]
    starts = np.concatenate(([0], np.cumsum(n_words)))
    for t in np.flatnonzero(~whole & (n_words > 0)):
        at, k = starts[t], n_words[t]
        h[at : at + 1] = np.sum(words[at : at + k] * _WORD[:k], dtype=np.uint64, keepdims=True) + _WORD[width + 1 : width + 2] * np.uint64(k)
        inside[at] = True
    h, text_of = mix(h[inside]), text_of[inside]
    order = np.lexsort((h, text_of))
    h, text_of = h[order], text_of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text_of[1:] != text_of[:-1])
    h, text_of = h[new], text_of[new]
    return np.searchsorted(text_of, np.arange(len(texts) + 1)), h


def set_digests(starts: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that stand for each whole set; 0 for an empty one."""
    out = []
    for seed in (0x1234567, 0x89ABCDEF01):
        run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(seed)), dtype=np.uint64)))
        out.append((run[starts[1:]] - run[starts[:-1]]).view(np.int64))
    return out[0], out[1]


def slices(sizes: list[int], most: int = 1 << 20):
    """(from, to) over consecutive texts of about ``most`` characters together."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        total += n + 1
        if total >= most:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(sizes):
        yield at, len(sizes)
