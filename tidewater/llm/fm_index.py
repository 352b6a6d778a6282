"""A compressed full-text index over word codes, and matching statistics by backward search.

The index is the wavelet matrix of a Burrows-Wheeler transform (one bit for each
word and level, with running counts), the longest common prefixes (one byte each)
and, for each suffix, the number of its document. All searches of a shard run in
lockstep: each numpy operation takes one step of every pattern.
"""

from __future__ import annotations

from typing import List, Tuple

import numpy as np


def _ranks(codes: np.ndarray, depth: int) -> List[np.ndarray]:
    """Ranks of the rotations by their first 1, 2, 4, .. words, up to ``depth`` words or until all differ."""
    n = len(codes)
    out, h = [np.unique(codes, return_inverse=True)[1].astype(np.int32)], 1
    while h < depth and out[-1].max() + 1 < n:
        key = out[-1].astype(np.int64) * n + np.roll(out[-1], -h)
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(np.append(False, key[1:] != key[:-1]), dtype=np.int32)
        out.append(rank)
        h *= 2
    return out


class _Minima:
    """Smallest value of any range of an array, from tables of ranges of 1, 2, 4, .. values."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while 2 << (len(self.tables) - 1) <= len(values):
            t, h = self.tables[-1], 1 << (len(self.tables) - 1)
            self.tables.append(np.minimum(t[:-h], t[h:]))
        size = max(map(len, self.tables))
        self.flat = np.concatenate([np.pad(t, (0, size - len(t)), mode="edge") for t in self.tables])
        self.size = size

    def over(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of lo..hi-1; every range holds a value."""
        k = np.frexp((hi - lo).astype(np.float64))[1] - 1
        return np.minimum(self.flat[k * self.size + lo], self.flat[k * self.size + hi - (1 << k)])

    def last_below(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Largest j <= at whose value is below ``bound``; value 0 must be."""
        at = at.copy()
        for k in range(len(self.tables) - 1, -1, -1):
            lo = at - (1 << k) + 1
            far = (lo >= 0) & (self.flat[k * self.size + np.maximum(lo, 0)] >= bound)
            at[far] -= 1 << k
        return at

    def first_below(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Smallest j >= at whose value is below ``bound``, or the length where none is."""
        at, n = at.copy(), len(self.tables[0])
        for k in range(len(self.tables) - 1, -1, -1):
            far = (at + (1 << k) <= n) & (self.flat[k * self.size + np.minimum(at, n - 1)] >= bound)
            at[far] += 1 << k
        return at


class FMIndex:
    """Index of segments: ``codes`` (from 1) of all words one after the other, ``lengths`` of the
    segments (at most ``depth`` words each), ``owners`` the number of each segment's document."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, owners: np.ndarray, depth: int):
        ends = np.cumsum(lengths)
        text = np.zeros(len(codes) + len(lengths), np.int32)  # each segment ends with a 0
        owner = np.repeat(owners.astype(np.int32), lengths + 1)
        inside = np.ones(len(text), bool)
        inside[ends + np.arange(len(lengths))] = False
        text[inside] = codes
        n = len(text)
        ranks = _ranks(text, depth)
        order = np.argsort(ranks[-1], kind="stable")
        self.owner = _Minima(owner[order])
        shared, at, other = np.zeros(n, np.int64), order[1:].copy(), order[:-1].copy()
        for d in range(len(ranks) - 1, -1, -1):
            same = ranks[d][at] == ranks[d][other]
            shared[1:] += same << d
            at, other = (at + (same << d)) % n, (other + (same << d)) % n
        self.shared = _Minima(np.minimum(shared, 255).astype(np.int16))
        self.shared.flat[0] = self.shared.tables[0][0] = -1  # nothing comes before the first suffix
        self.n = n

        bwt = text[order - 1]
        count = np.bincount(text)
        self.levels = max(1, int(len(count) - 1).bit_length())
        self.bits: List[np.ndarray] = []
        self.before: List[np.ndarray] = []
        self.zeros: List[int] = []
        symbol = np.arange(len(count))
        start = np.zeros(len(count), np.int64)  # where a symbol's run begins below the last level
        for b in range(self.levels - 1, -1, -1):
            one = (bwt >> b & 1).astype(bool)
            packed = np.packbits(np.pad(one, (0, -len(one) % 64 + 64)), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.before.append(np.append(0, np.cumsum(np.bitwise_count(packed), dtype=np.int64))[:-1])
            self.zeros.append(int(n - one.sum()))
            start = self._below(len(self.bits) - 1, symbol >> b & 1, start)
            bwt = np.concatenate([bwt[~one], bwt[one]])
        self.shift = np.append(0, np.cumsum(count))[:-1] - start

    def _below(self, level: int, bit: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Position i of a level, followed to the next one along ``bit``."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        ones = self.before[level][word] + np.bitwise_count(self.bits[level][word] & mask)
        return np.where(bit == 1, self.zeros[level] + ones, i - ones)

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Backward search: the border i of an interval, after putting ``symbol`` in front."""
        for level in range(self.levels):
            i = self._below(level, symbol >> (self.levels - 1 - level) & 1, i)
        return i + self.shift[symbol]

    def matching_statistics(self, codes: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """For each word of the patterns: how many words from there on also stand, in this order,
        in a segment whose owner has a smaller number than the pattern's."""
        out = np.zeros(len(codes), np.int64)
        first = np.cumsum(lengths) - lengths
        at = np.cumsum(lengths)  # the word after the next one to take
        live = np.flatnonzero(lengths > 0)
        lo, hi = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n, np.int64)
        size = np.zeros(len(lengths), np.int64)
        while len(live):
            symbol = codes[at[live] - 1]
            both = self.step(np.concatenate([symbol, symbol]), np.concatenate([lo[live], hi[live]]))
            low, high = both[: len(live)], both[len(live) :]
            ok = high > low
            ok[ok] = self.owner.over(low[ok], high[ok]) < owners[live[ok]]
            done = live[ok]
            lo[done], hi[done] = low[ok], high[ok]
            size[done] += 1
            at[done] -= 1
            out[at[done]] = size[done]
            failed = live[~ok]
            bare = failed[size[failed] == 0]
            at[bare] -= 1  # this word alone is in no smaller document
            short = failed[size[failed] > 0]
            if len(short):
                # Drop words at the right end: to the parent interval.
                a, z = lo[short], hi[short]
                keep = np.maximum(self.shared.tables[0][a], np.where(z < self.n, self.shared.tables[0][np.minimum(z, self.n - 1)], -1))
                keep = np.maximum(keep, 0)
                some = keep > 0
                lo[short[~some]], hi[short[~some]] = 0, self.n
                s = short[some]
                lo[s] = self.shared.last_below(a[some], keep[some])
                hi[s] = self.shared.first_below(z[some], keep[some])
                size[short] = keep
            live = live[at[live] > first[live]]
        return out


def runs(hit: np.ndarray, group: np.ndarray) -> Tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of hits within one group."""
    i = np.flatnonzero(hit)
    if not len(i):
        return i, i
    new = np.append(True, (np.diff(i) > 1) | (group[i[1:]] != group[i[:-1]]))
    return i[new], i[np.append(np.flatnonzero(new)[1:] - 1, len(i) - 1)]
