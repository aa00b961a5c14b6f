"""Pairs that can lie within a limit, for the metrics without a matrix product.

``Bounds(v, metric).pairs(q, limit)`` returns the pairs of a block whose lower
bound is within each query's limit: all pairs that are, and a few more, whose
distances the caller computes.

L1: each component of an item stands for one of ``CELLS`` cells, two
components share a byte.  A query's distances from the cells' centres are a
table of small whole numbers, rounded down; the rows of an item's bytes, all
queries side by side, add up to a bound once the item's own distance from its
centres is taken off.  Sums are bytes for ``_RUN`` tables at a time, then two
bytes.

L-infinity: for each component, bit rows hold the items below each of ``CUTS``
cuts.  The items of a span are the difference of two rows, those of all spans
their intersection, 64 items a word.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np

METRICS = ("l1", "linf")
CELLS, CUTS = 16, 64
LARGEST, FARTHEST = 1e30, 1e100  # components and limits that are bounded here are smaller
MANY = 0.3  # share of pairs within their bounds beyond which whole distances cost less
ROWS, ITEMS = 512, 512  # queries and items of a step
_RUN = 4
_MOST = 15_000  # of a sum, and of what an item or a limit adds to it
_SAMPLE = 1024


class _Sums:
    """L1 bounds."""

    def __init__(self, v: np.ndarray):
        n, dim = v.shape
        sample = np.sort(v[::max(1, n // _SAMPLE)], axis=0)
        normal = NormalDist()  # cells as wide as the square root of a density asks for
        share = np.array([normal.cdf(2**0.5 * normal.inv_cdf(i / CELLS)) for i in range(1, CELLS)])
        edges = sample[(share * len(sample)).astype(np.int64)].T
        cells = np.zeros((dim + dim % 2, n), dtype=np.intp)
        self.centres = np.zeros((dim + dim % 2, CELLS))
        self.own = np.zeros(n)
        for j in range(dim):
            column = np.ascontiguousarray(v[:, j])
            cells[j] = np.searchsorted(edges[j], column, side="right")
            self.centres[j] = np.bincount(cells[j], column, CELLS) / np.maximum(1, np.bincount(cells[j], minlength=CELLS))
            self.own += np.abs(column - self.centres[j][cells[j]])
        self.words = cells[::2] + CELLS * cells[1::2]
        self.most = float(np.abs(v).max(initial=0.0))

    def _tables(self, q: np.ndarray, step: float, cap: int) -> np.ndarray:
        """(words, entries, queries) in bytes: steps of each query from each pair of cells, rounded down."""
        whole = np.zeros((len(self.centres), len(q)))
        whole[:q.shape[1]] = q.T
        gap = np.abs(whole[:, None, :] - self.centres[:, :, None])
        gap *= 64 / step
        np.minimum(gap, 64 * cap, out=gap)
        gap = gap.astype(np.uint16)
        out = np.empty((len(self.words), CELLS * CELLS, len(q)), dtype=np.uint8)
        for s in range(len(out)):
            both = gap[2 * s][None] + gap[2 * s + 1][:, None]
            both >>= 6
            np.minimum(both, cap, out=both)
            out[s] = both.reshape(CELLS * CELLS, -1)
        return out

    def pairs(self, q: np.ndarray, limit: np.ndarray):
        count, n = len(q), len(self.own)
        words = len(self.words)
        cap = min(255 // _RUN, _MOST // words)
        if len(q) % 16:  # whole words of a row; a row that is added finds nothing
            more = 16 - len(q) % 16
            q, limit = np.concatenate((q, np.repeat(q[-1:], more, 0))), np.r_[limit, np.full(more, -np.inf)]
        step = max(3 * float(limit[:count].max()) / (words * cap), 1e-6 * max(self.most, float(np.abs(q).max())), 1e-300)
        tables = self._tables(q, step, cap)
        own = np.minimum(np.ceil(self.own / step) + 1, _MOST).astype(np.int16)
        asked = np.clip(np.floor(limit / step) + 1, -2 * _MOST, _MOST).astype(np.int16)
        size = min(ITEMS, n), len(q)
        sums8, row8 = np.empty(size, dtype=np.uint8), np.empty(size, dtype=np.uint8)
        halves = [np.empty((size[0], len(q) // 2), dtype=np.uint16) for _ in range(3)]
        found, held = [], 0
        for at in range(0, n, ITEMS):
            k = min(ITEMS, n - at)
            part, row = sums8[:k], row8[:k]
            even, odd, some = (x[:k] for x in halves)
            for first in range(0, words, _RUN):
                np.take(tables[first], self.words[first, at:at + k], axis=0, out=part, mode="clip")
                for s in range(first + 1, min(first + _RUN, words)):
                    np.take(tables[s], self.words[s, at:at + k], axis=0, out=row, mode="clip")
                    np.add(part, row, out=part)
                two = part.view("<u2")
                if not first:
                    np.bitwise_and(two, 255, out=even)
                    np.right_shift(two, 8, out=odd)
                    continue
                np.bitwise_and(two, 255, out=some)
                np.add(even, some, out=even)
                np.right_shift(two, 8, out=some)
                np.add(odd, some, out=odd)
            for total, which in ((even, 0), (odd, 1)):
                edge = some.view(np.int16)
                np.add(own[at:at + k, None], asked[which::2], out=edge)
                near = np.flatnonzero(total.view(np.int16) <= edge)
                item = near // (len(q) // 2)
                found.append((2 * (near - item * (len(q) // 2)) + which, at + item))
                held += len(near)
            if held > MANY * count * (at + k):
                return None
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class _Spans:
    """L-infinity bounds."""

    def __init__(self, v: np.ndarray):
        n, dim = v.shape
        self.words = -(-n // 64)
        sample = np.sort(v[::max(1, n // _SAMPLE)], axis=0)
        self.edges = np.ascontiguousarray(sample[np.arange(1, CUTS) * len(sample) // CUTS].T)
        bits = np.zeros((dim, CUTS + 1, 8 * self.words), dtype=np.uint8)
        cut = np.arange(CUTS + 1, dtype=np.uint8)[:, None]
        for j in range(dim):
            cell = np.searchsorted(self.edges[j], v[:, j], side="right").astype(np.uint8)
            bits[j, :, :-(-n // 8)] = np.packbits(cell < cut, axis=1, bitorder="little")
        self.below = bits.view("<u8")
        self.most = float(np.abs(v).max(initial=0.0))

    def pairs(self, q: np.ndarray, limit: np.ndarray):
        # more than what rounding of the spans' ends and of the distances takes
        reach = limit + 1e-9 * (np.abs(limit) + np.abs(q).max(axis=1, initial=0.0) + self.most) + 1e-300
        both, row, low = (np.empty((len(q), self.words), dtype=np.uint64) for _ in range(3))
        for j in range(q.shape[1]):
            start = np.searchsorted(self.edges[j], q[:, j] - reach, side="right")
            end = np.searchsorted(self.edges[j], q[:, j] + reach, side="right") + 1
            end = np.maximum(start, end)  # nothing within a negative limit
            np.take(self.below[j], end, axis=0, out=row, mode="clip")
            np.take(self.below[j], start, axis=0, out=low, mode="clip")
            np.bitwise_xor(row, low, out=row)
            if j:
                np.bitwise_and(both, row, out=both)
            else:
                both, row = row, both
        qi, word = np.nonzero(both)
        bits = both[qi, word]
        if int(np.bitwise_count(bits).sum(dtype=np.int64)) > MANY * len(q) * 64 * self.words:
            return None
        at, bit = np.nonzero(np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return qi[at], 64 * word[at] + bit


class Bounds:
    """Bounds of the items ``v`` (finite, of components below ``LARGEST``); made once for many query blocks."""

    def __init__(self, v: np.ndarray, metric: str):
        self.kind = (_Sums if metric == "l1" else _Spans)(v)

    def pairs(self, q: np.ndarray, limit: np.ndarray):
        """``(query rows, item rows)`` of all pairs with a distance up to ``limit`` (below ``FARTHEST``) and some others; None where these are many."""
        return self.kind.pairs(q, limit)
