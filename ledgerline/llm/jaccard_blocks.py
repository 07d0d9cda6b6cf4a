"""Exact links inside a block of sets, in one task: metric division by Jaccard distances, counted overlaps, a spanning forest.

Sets are arrays of distinct 64-bit hashes. Memory follows the sets and ``AT_ONCE`` pairs; what leaves is at most one
link less than there are members, however many pairs are within the radius.
"""

from fractions import Fraction

import numpy as np

#: Pairs that are compared at once, columns of a dense part, and how many pairs one shingle may make outside it.
AT_ONCE, COLUMNS, SPARSE = 1 << 18, 1_024, 16
#: Pairs of equal shingles that are listed at once.
LISTED = 1 << 20


class Forest:
    """Which of some numbers are connected."""

    def __init__(self, size: int):
        self.above = list(range(size))

    def root(self, x: int) -> int:
        while self.above[x] != x:
            self.above[x] = x = self.above[self.above[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether they were not connected yet."""
        one, other = self.root(x), self.root(y)
        self.above[one] = other
        return one != other


class Sets:
    """Some sets with their shingles numbered from 0."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        values, codes = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.zeros(0), np.zeros(0, np.int64))
        self.codes, self.width = codes.astype(np.int32), len(values)

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of some sets the position of each entry's set in ``rows``, and the entry's code."""
        codes = [self.codes[self.first[x] : self.first[x + 1]] for x in rows]
        return np.repeat(np.arange(len(rows), dtype=np.int32), self.sizes[rows]), np.concatenate(codes) if codes else self.codes[:0]

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many shingles every set of ``a`` has in common with every set of ``b``.

        Only shingles found on both sides are looked at, in numbers of 32 bits: few of them bring their pairs one by one,
        ``LISTED`` at a time, those of many pairs are counted by products of dense parts.
        """
        (ra, ca), (rb, cb) = self.entries(a), self.entries(b)
        both = np.zeros(self.width, bool)
        both[ca] = True
        met = np.zeros(self.width, bool)
        met[cb] = True
        both &= met
        place = np.cumsum(both, dtype=np.int32) - 1  # shingles of both sides are numbered anew
        width = int(place[-1]) + 1 if self.width else 0
        ra, ca = ra[ka := both[ca]], place[ca[ka]]
        rb, cb = rb[kb := both[cb]], place[cb[kb]]
        del met, both, place, ka, kb
        na, nb = np.bincount(ca, minlength=width).astype(np.int32), np.bincount(cb, minlength=width).astype(np.int32)
        few = na.astype(np.int64) * nb <= SPARSE
        found = np.zeros(len(a) * len(b), np.int64)
        ka, kb = few[ca], few[cb]
        left, code = ra[ka], ca[ka]
        right = rb[kb][np.argsort(cb[kb], kind="stable")]
        begins = np.concatenate(([0], np.cumsum(np.where(few, nb, 0))))
        step = max(1, LISTED // max(1, SPARSE))
        for start in range(0, len(left), step):
            some, of = left[start : start + step], code[start : start + step]
            times = nb[of]
            at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begins[of], times)
            found += np.bincount(np.repeat(some.astype(np.int64), times) * len(b) + right[at], minlength=len(found))
        found = found.reshape(len(a), len(b))
        many = np.flatnonzero(~few)
        place = np.full(width, -1, np.int32)
        place[many] = np.arange(len(many))
        pa, pb = place[ca], place[cb]
        for start in range(0, len(many), COLUMNS):
            x, y = np.zeros((len(a), COLUMNS), np.float32), np.zeros((len(b), COLUMNS), np.float32)
            ia, ib = (pa >= start) & (pa < start + COLUMNS), (pb >= start) & (pb < start + COLUMNS)
            x[ra[ia], pa[ia] - start] = 1
            y[rb[ib], pb[ib] - start] = 1
            found += (x @ y.T).astype(np.int64)
        return found

    def distances(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        """Jaccard distances of some sets to one; an empty set is at 1 from all others."""
        shared = self.shared(np.array([pivot]), rows)[0]
        return 1 - shared / np.maximum(1, self.sizes[pivot] + self.sizes[rows] - shared)


def parts_within(sets: Sets, a: np.ndarray, b: np.ndarray, radius: float):
    """Pairs of index arrays that together hold every pair of one of ``a`` and one of ``b`` within ``radius``.

    Recursive division of the metric space: a member is the pivot, those within the median distance are divided from
    those beyond, and by the triangle inequality pairs across the border lie in windows on both sides of it.
    Where the windows hold nearly everything, the parts are compared as they are.
    """
    slack = radius + 1e-9  # distances are rounded; a wider window loses nothing
    work = [(a, b)]
    while work:
        a, b = work.pop()
        if not len(a) or not len(b):
            continue
        if len(a) * len(b) > AT_ONCE:
            pivot = int(a[len(a) // 2])
            da, db = sets.distances(pivot, a), sets.distances(pivot, b)
            apart = np.concatenate((da, db))
            border = np.median(apart)
            if border == apart.max() > apart.min():  # most share nothing with the pivot: divide off those that do
                border = np.median(apart[apart < border])
            parts = [
                (a[da <= border], b[db <= border]),
                (a[da > border], b[db > border]),
                (a[(da <= border) & (da >= border - slack)], b[(db > border) & (db <= border + slack)]),
                (a[(da > border) & (da <= border + slack)], b[(db <= border) & (db >= border - slack)]),
            ]
            if sum(len(x) * len(y) for x, y in parts) < 0.9 * len(a) * len(b):
                work.extend(parts)
                continue
        step = max(1, AT_ONCE // len(b))
        for k in range(0, len(a), step):
            yield a[k : k + step], b


def forest(sets: Sets, part: np.ndarray, minor: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: Fraction) -> list[tuple[int, int]]:
    """Links that connect all parts which pairs of one of ``left`` and one of ``right`` connect, none more than needed.

    Only pairs of two parts are looked at, one of them minor. ``part`` numbers the connected part of each set.
    """
    s = similarity
    joined = Forest(int(part.max()) + 1 if len(part) else 0)
    links = []
    for a, b in parts_within(sets, left, right, float(1 - s)):
        shared = sets.shared(a, b)
        union = sets.sizes[a][:, None] + sets.sizes[b][None] - shared
        near = (shared > 0) & (shared * s.denominator >= union * s.numerator)
        near &= (part[a][:, None] != part[b][None]) & (minor[a][:, None] | minor[b][None])
        for x in np.flatnonzero(near.any(axis=1)):
            met, first = np.unique(part[b[near[x]]], return_index=True)  # of the parts a set is near to, one link each is enough
            for p, y in zip(met.tolist(), b[near[x]][first].tolist()):
                if joined.join(int(part[a[x]]), p):
                    links.append((int(a[x]), y))
    return links
