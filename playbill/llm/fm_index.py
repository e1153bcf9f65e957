"""An FM-index over words: wavelet matrix, backward search, matching statistics.

Everything works on many patterns at a time. Suffixes are sorted by their first
``DEPTH`` symbols, which is enough for matches up to that length.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


class WaveletMatrix:
    """Symbols below ``sigma``, a plane of packed bits for each bit of a symbol, highest first."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.n, self.bits = len(symbols), max(1, int(sigma - 1).bit_length())
        self.planes, self.zeros = [], []
        left = symbols
        for k in range(self.bits - 1, -1, -1):
            bit = (left >> k & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(self.n // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)))
            self.planes.append((words, before))
            self.zeros.append(self.n - int(bit.sum()))
            left = np.concatenate((left[~bit], left[bit]))

        #: Where each symbol's part of the last plane begins, which every count of it starts from.
        self.first = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (words, before) in enumerate(self.planes):
            part = words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = before[at >> 6] + np.bitwise_count(part)
            one = symbol >> (self.bits - 1 - level) & 1
            at = np.where(one == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs in the first ``at`` places (arrays of one shape)."""
        return self._down(symbol, at) - self.first[symbol]


def suffix_order(text: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in the order of their first ``depth`` symbols (a power of two), by prefix doubling.

    The second result numbers the suffixes by their first 1, 2, 4 ... symbols, below ``depth``.
    """
    n = len(text)
    order = np.argsort(text)
    keys, ranks, size = text[order], [], 1
    while True:
        new = np.concatenate(([False], keys[1:] != keys[:-1]))
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if size >= depth:
            return order, ranks
        ranks.append(rank)
        if new[1:].all():
            return order, ranks
        after = np.zeros(n, np.int64)
        after[: max(0, n - size)] = rank[size:] + 1
        joint = rank * (n + 1) + after
        order = np.argsort(joint)
        keys, size = joint[order], size * 2


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray], most: int) -> np.ndarray:
    """Longest common prefix, up to ``most``, of each suffix with the one before it; -1 at the first.

    Two suffixes with one number at a size share that many symbols, so the length
    is found by trying the sizes from the largest down.
    """
    n = len(order)
    out = np.zeros(n, np.int64)
    a, b = order[1:].copy(), order[:-1].copy()
    for level in range(len(ranks) - 1, -1, -1):
        rank = np.append(ranks[level], [-1, -2])  # past the end nothing is equal
        same = rank[np.minimum(a, n)] == rank[np.where(b < n, b, n + 1)]
        step = same.astype(np.int64) << level
        out[1:] += step
        a, b = a + step, b + step
    out = np.minimum(out, most)
    out[0] = -1
    return out


class FmIndex:
    """Passages of symbols from 1 on, with an owner number each; a match never crosses passages.

    ``most`` is the longest match told apart. Kept are the wavelet matrix of the
    transformed text, symbol counts, common prefixes in a byte each, and the
    smallest owner of each run of suffixes that share ``most`` symbols.
    """

    def __init__(self, passages: list[np.ndarray], owners: np.ndarray, most: int):
        if most >= DEPTH:
            raise ValueError(f"matches are told apart up to {DEPTH - 1} symbols")
        self.most = most
        text = np.concatenate([x for p in passages for x in (p, [0])]).astype(np.int64)
        owner = np.repeat(owners, [len(p) + 1 for p in passages])
        order, ranks = suffix_order(text)
        self.sigma = int(text.max()) + 1
        self.bwt = WaveletMatrix(text[order - 1], self.sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.sigma))))
        self.common = common_prefixes(order, ranks, most).astype(np.int8)
        self.runs = np.flatnonzero(self.common < most)
        self.least = np.minimum.reduceat(owner[order], self.runs)
        self.levels: dict[int, np.ndarray] = {most: self.runs}
        self.n = len(text)

    def _widened(self, lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of suffixes that share the first ``length`` symbols with the ones given."""
        if length not in self.levels:
            self.levels[length] = np.flatnonzero(self.common < length)
        starts = self.levels[length]
        at = np.searchsorted(starts, lo, "right")
        return starts[at - 1], np.append(starts, self.n)[at]

    def _parents(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The next wider intervals, and how many symbols their suffixes share."""
        common = np.append(self.common, -1)
        length = np.maximum(np.maximum(common[lo], common[hi]), 0).astype(np.int64)
        lo, hi = lo.copy(), hi.copy()
        for x in np.unique(length):
            at = length == x
            lo[at], hi[at] = self._widened(lo[at], hi[at], int(x))
        return lo, hi, length

    def matching_statistics(self, patterns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each place of the patterns in a row: longest match from there (up to ``most``) and its least owner.

        Patterns are read backward, all in step; a match that can't be extended is
        cut from behind, by the parents of its interval, until it can. Symbols the
        index doesn't know are 0. The owner is -1 where the match is shorter than ``most``.
        """
        sizes = np.array([len(p) for p in patterns], np.int64)
        ends = np.cumsum(sizes)
        flat = np.concatenate([*patterns, np.zeros(0, np.int64)]).astype(np.int64)
        flat[flat >= self.sigma] = 0
        lengths, owners = np.zeros(len(flat), np.int64), np.full(len(flat), -1, np.int64)
        rows = np.argsort(-sizes, kind="stable")
        lo, hi, got = np.zeros(len(rows), np.int64), np.full(len(rows), self.n), np.zeros(len(rows), np.int64)
        for step in range(int(sizes.max(initial=0))):
            count = np.searchsorted(-sizes[rows], -step, "left")
            at = ends[rows[:count]] - 1 - step
            symbol = flat[at]
            todo = np.arange(count)
            lost = todo[symbol[todo] == 0]
            lo[lost], hi[lost], got[lost] = 0, self.n, 0
            todo = todo[symbol[todo] > 0]
            while len(todo):
                s = symbol[todo]
                both = self.bwt.rank(np.concatenate((s, s)), np.concatenate((lo[todo], hi[todo])))
                a, b = self.before[s] + both[: len(s)], self.before[s] + both[len(s) :]
                found = a < b
                ok, bad = todo[found], todo[~found]
                lo[ok], hi[ok], got[ok] = a[found], b[found], got[ok] + 1
                none = bad[got[bad] == 0]
                todo = bad[got[bad] > 0]
                if len(todo):
                    lo[todo], hi[todo], got[todo] = self._parents(lo[todo], hi[todo])
                lo[none], hi[none] = 0, self.n
            full = np.flatnonzero(got[:count] >= self.most)
            lo[full], hi[full] = self._widened(lo[full], hi[full], self.most)
            got[full] = self.most
            owners[at[full]] = self.least[np.searchsorted(self.runs, lo[full], "right") - 1]
            lengths[at] = got[:count]
        return lengths, owners
