"""PartEnum signatures for a Jaccard join.

Set sizes fall into bands [l, l*100/percent]; sets that link lie in one band or in neighbours, so each
pair of neighbouring bands makes an instance, and a set takes part in two. Within an instance the
threshold bounds how many elements two linked sets differ by, k. The domain is dealt by hash into
n1 = k//2 + 1 + spare partitions, so at least spare + 1 of them hold at most one difference; each is
dealt on into n2 = 2 parts, of which one then agrees. The signatures of a set are the contents of all
subsets of n2 - 1 parts of all partitions: linked sets share one. (With n2 = 3 there are half as many
signatures again, each on more elements; the shuffle of the signatures is what costs most.)

Common features (those of passages that many documents share) may be left out of the domain: two sets
differ in no more elements of a part of the domain than in all of it, so the argument holds whichever
features are left out, and parts that hold nothing but a shared passage no longer bring strangers together.

An empty part says nothing and would be shared by everybody, so none is given for it. A set with at most
``spare`` partitions that have an empty part still shares a signature with every partner. A set with
more (a few in a thousand) also gives the signatures of prefix filtering: its first
n - ceil(n*percent/100) + 1 elements in one order of all features, common ones last. Two linked sets that both lack the former share one
of the latter, so no link is lost.
"""

from __future__ import annotations

from functools import cache

import numpy as np

from tallyquill.llm.shingles import mix

_A, _B, _C = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
_PREFIX = np.uint64(0x589965CC75374CC3)


@cache
def bands(percent: int, most: int) -> np.ndarray:
    """Least size of each band, the first beyond ``most`` included."""
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * 100 // percent + 1)
    return np.array([*out, out[-1] * 100 // percent + 1, (out[-1] * 100 // percent + 1) * 100 // percent + 1])


def signatures(starts: np.ndarray, h: np.ndarray, percent: int, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text index, signature) pairs of the sets given as by shingle_sets; common: features to leave out, ascending."""
    sizes = np.diff(starts)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = bands(percent, 1 << int(sizes.max()).bit_length())
    band = np.searchsorted(least, sizes, "right") - 1  # -1: empty
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    rare = np.ones(len(h), bool)
    if common is not None and len(common):
        rare = common[np.minimum(np.searchsorted(common, h), len(common) - 1)] != h
    owners, sigs, sparse = [], [], np.zeros(len(sizes), bool)
    for lower in (0, 1):
        instance = band - 1 + lower  # of bands (instance, instance + 1)
        top = least[np.clip(instance + 2, 0, len(least) - 1)] - 1
        k = 2 * top * (100 - percent) // (100 + percent)
        takes = (sizes > 0) & (instance >= 0) & (k > 0)  # with no difference allowed, the sets are equal
        spare = np.where(k >= 4, 1 + k // 48, 0)
        n1 = np.where(takes, k // 2 + 1 + spare, 0)
        at = np.concatenate(([0], np.cumsum(n1)))
        mine = takes[text_of] & rare
        t = text_of[mine]
        e = mix(h[mine] + (instance[t].astype(np.uint64) + np.uint64(1)) * _A)
        low = np.uint64(0xFFFFFFFF)
        first = ((e >> np.uint64(32)) * n1[t].astype(np.uint64)) >> np.uint64(32)
        second = ((e & low) * np.uint64(2)) >> np.uint64(32)
        cell = (at[t] + first.astype(np.int64)) * 2 + second.astype(np.int64)
        sums = np.zeros(2 * at[-1], np.uint64)
        np.add.at(sums, cell, mix(e ^ _B))
        counts = np.bincount(cell, minlength=2 * at[-1]).reshape(-1, 2)
        sums = sums.reshape(-1, 2)
        owner = np.repeat(np.arange(len(sizes)), n1)
        index = (np.arange(at[-1]) - at[owner]).astype(np.uint64)
        place = (instance[owner].astype(np.uint64) << np.uint64(32)) + index * np.uint64(2)
        weak = np.zeros(at[-1], bool)
        for part in (0, 1):
            full = counts[:, part] > 0
            weak |= ~full
            sigs.append(mix(sums[:, part] * _A + mix((place + np.uint64(part)) * _C))[full])
            owners.append(owner[full])
        sparse |= np.bincount(owner[weak], minlength=len(sizes)) > spare * takes
    for t in np.flatnonzero(sparse):
        n = int(sizes[t])
        own = h[starts[t] : starts[t + 1]]
        own = own[np.argsort(~rare[starts[t] : starts[t + 1]], kind="stable")]
        some = own[: n - -(-n * percent // 100) + 1]
        sigs.append(mix(some ^ _PREFIX))
        owners.append(np.full(len(some), t))
    return np.concatenate(owners), np.concatenate(sigs)
