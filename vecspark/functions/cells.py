"""Nearest of very many centroids by a two-level quantizer; the answer is exact.

The centroids are put into about the square root of their number of cells.
A cell has a centre and a radius, the largest distance of its members from
the centre.  By the triangle inequality no member is nearer to a vector than
the vector's distance from the centre less the radius.  A vector is compared
with the members of the cell of least bound first, and then, in order of the
bounds, with those of the cells whose bound does not exceed the distance
found.  Where the bounds leave most pairs (vectors without clusters), they
are compared in one block product instead.

For metrics with a triangle inequality (l2 by its root, l1, linf); ties go to
the lower list number, as in ``kernels.search_block``.
"""

from __future__ import annotations

import numpy as np

from vecspark.functions import kernels

LEAST = 1024  # centroids from which cells are made
ROUNDS = 4  # Lloyd rounds of the centres
BATCH = 4096  # vectors searched at once
_SLACK = 1e-9


def layout(v: np.ndarray, metric: str):
    """``(centres, radii, order, starts)`` of the cells of ``v``; None where they are not used."""
    n = len(v)
    if n < LEAST or metric not in ("l2", "l1", "linf") or not np.isfinite(v).all():
        return None
    number = int(np.sqrt(n))
    centres = v[np.arange(number) * (n - 1) // (number - 1)].copy()
    ids = np.arange(number)
    for _ in range(ROUNDS):
        _, own, _ = kernels.search_block(v, centres, ids, metric, k=1)
        sums, counts = np.zeros_like(centres), np.bincount(own, minlength=number)
        np.add.at(sums, own, v)
        held = counts > 0
        centres[held] = sums[held] / counts[held, None]
    _, own, d = kernels.search_block(v, centres, ids, metric, k=1)
    radii = np.zeros(number)
    np.maximum.at(radii, own, _length(d, metric))
    order = np.argsort(own, kind="stable")
    return centres, radii, order, np.r_[0, np.cumsum(np.bincount(own, minlength=number))]


def _length(d: np.ndarray, metric: str) -> np.ndarray:
    return np.sqrt(d) if metric == "l2" else d


class Nearest:
    """Nearest of the rows ``v`` (numbered ``ids``) for blocks of vectors; ``cells`` is their ``layout``."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, metric: str, cells=None):
        self.v, self.ids, self.metric = v, ids, metric
        self.prep = kernels.prepare_items(v, metric)
        self.cells, self.compared = cells, 0
        if cells is not None:
            centres, _, order, starts = cells
            self.numbers = np.arange(len(centres))
            self.centre_prep = kernels.prepare_items(centres, metric)
            self.members = [order[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
            self.preps = [kernels.prepare_items(v[m], metric) for m in self.members]

    def search(self, q: np.ndarray) -> np.ndarray:
        """Position in ``v`` of the nearest of each vector; -1 for a vector with no finite distance."""
        out = np.full(len(q), -1, dtype=np.int64)
        if self.cells is None:
            at, pos, _ = kernels.search_block(q, self.v, self.ids, self.metric, k=1, prep=self.prep)
            self.compared += len(q) * len(self.v)
            out[at] = pos
            return out
        rows = np.flatnonzero(np.isfinite(q).all(axis=1))
        for s in range(0, len(rows), BATCH):
            part = rows[s:s + BATCH]
            out[part] = self._search(q[part])
        return out

    def _search(self, q: np.ndarray) -> np.ndarray:
        number = len(self.numbers)
        at, cell, d = kernels.search_block(q, self.cells[0], self.numbers, self.metric, k=number, prep=self.centre_prep)
        away = np.zeros((len(q), number))
        away[at, cell] = _length(d, self.metric)
        self.compared += away.size
        # Rounding of the distances must not lose a nearest one.
        bound = away - self.cells[1] - _SLACK * (1 + away + self.cells[1])
        ranked = np.argsort(bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, ranked, axis=1)
        best, pos = np.full(len(q), np.inf), np.full(len(q), -1, dtype=np.int64)
        sizes = np.array([len(m) for m in self.members])
        for j in range(number):
            left = np.flatnonzero(bound[:, j] <= _length(best, self.metric))
            if not len(left):
                break
            if j == 1 and 2 * (sizes[ranked] * (bound <= _length(best, self.metric)[:, None])).sum() > len(q) * len(self.v):
                _, pos, _ = kernels.search_block(q, self.v, self.ids, self.metric, k=1, prep=self.prep)
                self.compared += len(q) * len(self.v)
                return pos
            for (c,), some in kernels.group_rows([ranked[left, j]]):
                self._meet(q, left[some], c, best, pos)
        return pos

    def _meet(self, q, rows, c, best, pos) -> None:
        """Compare vectors with the members of a cell."""
        members = self.members[c]
        if not len(members):
            return
        self.compared += len(rows) * len(members)
        at, m, d = kernels.search_block(q[rows], self.v[members], self.ids[members], self.metric, k=1, prep=self.preps[c])
        rows, found = rows[at], members[m]
        lower = (d < best[rows]) | ((d == best[rows]) & (self.ids[found] < self.ids[pos[rows]]))
        best[rows[lower]], pos[rows[lower]] = d[lower], found[lower]
