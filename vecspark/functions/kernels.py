"""NumPy block kernels that run inside Spark tasks.

Spark decides which rows meet in a task (a broadcast side against a
streamed batch, or one cogrouped tile); these functions only turn two
bounded blocks of vectors into the few rows worth emitting: the k best
partners of every query, or every partner inside a radius.  The full
distance matrix of a block never leaves the task.

Distances are computed in float64.  For L2 and inner product the
candidate set is chosen with a matrix product (BLAS), then the distances
of the chosen pairs are recomputed directly, so the emitted values do
not depend on the cancellation error of the expanded form.

A vector with a NaN or infinite component has no finite distance to
anything: as an item it is never a hit, as a query it has none.  Such rows
are set aside before any matrix is formed, so they cannot touch the error
bounds of the others.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa

from vecspark.functions import bounds

# Bytes of one float64 distance matrix chunk held at a time.
_CHUNK_BYTES = 8 << 20
# Rows and columns of an L1 or L-infinity matrix made at a time (they stay in a core's cache), components between
# two looks at what is still near, and the share of pairs that are rather computed one by one.
_PART = 4, 4096
_LOOK, _FEW = 16, 0.02
# Bytes of gathered vectors when chosen pairs are re-computed (they stay in a core's cache).
PAIR_BYTES = 1 << 18
# Items from which an L1 or L-infinity search uses bounds, and distances for each of ``k`` that make a query's first limit.
_LEAST, _SEEDS = 512, 8


def larger_is_nearer(metric: str) -> bool:
    return metric == "ip"


def list_matrix(col, dim: int) -> np.ndarray:
    """Arrow list column of equal-length vectors -> (n, dim) float64."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    n = len(col)
    if n == 0:
        return np.zeros((0, dim), dtype=np.float64)
    if col.null_count:
        raise ValueError("vector column holds NULL vectors")
    values = col.flatten()
    if len(values) != n * dim:
        raise ValueError(f"vectors are not all of dimension {dim}")
    if values.null_count:
        raise ValueError("vector holds NULL elements")
    return values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, dim)


def _pairs_exact(q: np.ndarray, v: np.ndarray, qi: np.ndarray, vi: np.ndarray, metric: str) -> np.ndarray:
    """Distances of the pairs ``q[qi], v[vi]``, gathering a bounded number of vectors at a time."""
    step = max(1, PAIR_BYTES // (16 * max(1, q.shape[1])))
    if len(qi) <= step:
        return pair_exact(q[qi], v[vi], metric)
    return np.concatenate([pair_exact(q[qi[i:i + step]], v[vi[i:i + step]], metric) for i in range(0, len(qi), step)])


def pair_exact(q: np.ndarray, v: np.ndarray, metric: str) -> np.ndarray:
    """Row-wise distance of aligned pairs q[i], v[i]."""
    if metric == "l2":
        diff = q - v
        return np.einsum("ij,ij->i", diff, diff)
    if metric == "ip":
        return np.einsum("ij,ij->i", q, v)
    if metric == "l1":
        return np.abs(q - v).sum(axis=1)
    if metric == "linf":
        return np.abs(q - v).max(axis=1) if q.shape[1] else np.zeros(len(q))
    raise ValueError(f"unknown metric {metric!r}")


def _block(q: np.ndarray, v: np.ndarray, metric: str, vn: np.ndarray | None, v_sel: np.ndarray | None,
           limit: np.ndarray | None = None):
    """Selection matrix ``s``, per-row offset ``o`` and error bound ``tol``.

    ``s + o[:, None]`` approximates the distances; ``o`` is constant within a
    row, so ``s`` alone orders each row.  For L2, ``s = |v|^2 - 2 q.v`` (one
    matrix product against ``v_sel = -2 v`` and one pass), ``o = |q|^2``.
    L1 and L-infinity (``o = 0``) are summed in single precision from the
    transposed items ``v_sel``; in double where a value is too large for it.
    Both only grow with the components: under a ``limit`` per row, a part of
    which few pairs are left within it stays a lower bound.
    """
    if metric in ("l2", "ip"):
        qn = np.einsum("ij,ij->i", q, q)
        vmax = float(vn.max()) if len(vn) else 0.0
        tol = 1e-9 * (qn + vmax) + 1e-12
        if metric == "l2":
            s = q @ v_sel.T
            s += vn[None, :]
            return s, qn, tol
        return q @ v.T, np.zeros(len(q)), tol
    most = max(float(np.abs(q).max(initial=0.0)), float(vn.max(initial=0.0)))
    kind = np.float32 if most < 1e30 else np.float64
    qs, vt = q.astype(kind), v_sel if kind is np.float32 else np.ascontiguousarray(v.T)
    d = np.zeros((len(q), len(v)), dtype=kind)
    rows, columns = _PART
    gap = np.empty((rows, columns), dtype=kind)
    join = np.add if metric == "l1" else np.maximum
    size = np.abs(q).sum(axis=1) if metric == "l1" else np.abs(q).max(axis=1, initial=0.0)
    terms = q.shape[1] + 4 if metric == "l1" else 4
    tol = np.finfo(kind).eps * terms * (size + vn.max(initial=0.0)) + 1e-30
    edge = None if limit is None else (limit + tol)[:, None]
    for a in range(0, len(q), rows):
        for b in range(0, len(v), columns):
            part = d[a:a + rows, b:b + columns]
            own = gap[:part.shape[0], :part.shape[1]]
            for j in range(q.shape[1]):
                np.subtract(qs[a:a + rows, j, None], vt[None, j, b:b + columns], out=own)
                np.abs(own, out=own)
                join(part, own, out=part)
                if edge is not None and j % _LOOK == _LOOK - 1 and np.count_nonzero(part <= edge[a:a + rows]) <= _FEW * part.size:
                    break
    return d, np.zeros(len(q)), tol


def rank_pairs(qi, vi, d, ids, k, larger):
    """Keep the k best (distance, id) per query index; ties go to the lower id."""
    if len(qi) == 0:
        return qi, vi, d
    primary = -d if larger else d
    order = np.lexsort((ids[vi], primary, qi))
    qi, vi, d = qi[order], vi[order], d[order]
    if k is None:
        return qi, vi, d
    starts = np.r_[0, np.flatnonzero(np.diff(qi)) + 1]
    run = np.repeat(starts, np.diff(np.r_[starts, len(qi)]))
    keep = (np.arange(len(qi)) - run) < k
    return qi[keep], vi[keep], d[keep]


def prepare_items(v: np.ndarray, metric: str) -> dict:
    """Per-block values the kernel needs for ``v``; compute once, reuse for every query batch."""
    v = np.ascontiguousarray(v, dtype=np.float64)
    finite = np.isfinite(v).all(axis=1)
    kept = None if finite.all() else np.flatnonzero(finite)
    if kept is not None:
        v = v[kept]
    if metric in ("l2", "ip"):
        vn, v_sel = np.einsum("ij,ij->i", v, v), -2.0 * v if metric == "l2" else None
    else:
        vn = np.abs(v).sum(axis=1) if metric == "l1" else np.abs(v).max(axis=1, initial=0.0)
        with np.errstate(over="ignore"):  # not used where a value is too large
            v_sel = np.ascontiguousarray(v.T, dtype=np.float32)
    return {
        "kept": kept,  # rows that can be hits, if not all
        "v": v,
        "vn": vn,
        "v_sel": v_sel,
    }


def search_block(q: np.ndarray, v: np.ndarray, ids: np.ndarray, metric: str,
                 k: int | None = None, radius: float | None = None, prep: dict | None = None,
                 limit: np.ndarray | None = None):
    """Best partners of every row of ``q`` among the rows of ``v``.

    Returns ``(query_row, item_row, distance)`` arrays, sorted by query row,
    then nearness, then item id.  ``k`` keeps the k best per query;
    ``radius`` keeps every pair strictly nearer than the radius (``<`` for
    distances, ``>`` for inner product).  ``prep`` is ``prepare_items(v)``
    when the same items meet many query blocks.  ``limit`` holds each query's
    known k-th distance: where a block's are all finite, what is farther is
    left out, and up to all nearer or equal partners are looked at.
    """
    nq, nv = len(q), len(v)
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    if nq == 0 or nv == 0 or (k is not None and k <= 0):
        return empty
    if prep is None:
        prep = prepare_items(v, metric)
    vn, kept = prep["vn"], prep["kept"]
    asked = np.isfinite(q).all(axis=1)
    asked = None if asked.all() else np.flatnonzero(asked)
    if asked is not None:
        q, limit = q[asked], limit if limit is None else limit[asked]
    if kept is not None:
        v, ids = prep["v"], ids[kept]
    nq, nv = len(q), len(v)
    if nq == 0 or nv == 0:
        return empty
    if _boundable(q, v, metric, vn) and (radius is None or abs(radius) < bounds.FARTHEST):
        qi, vi, d = _search_bounded(q, v, ids, metric, k, radius, prep, limit)
    else:
        qi, vi, d = _search_whole(q, v, ids, metric, k, radius, prep, limit)
    return qi if asked is None else asked[qi], vi if kept is None else kept[vi], d


def _search_whole(q, v, ids, metric, k, radius, prep, limit):
    """``search_block`` by a matrix of all pairs, a bounded number of queries at a time."""
    larger = larger_is_nearer(metric)
    vn, v_sel = prep["vn"], prep["v_sel"]
    nq, nv = len(q), len(v)
    step = max(1, _CHUNK_BYTES // (8 * nv))
    if k is not None and k >= nv:
        step = max(1, step // 8)  # every pair of the chunk is ranked
    out_q, out_v, out_d = [], [], []
    for s in range(0, nq, step):
        qc = q[s:s + step]
        near = None if radius is None or metric not in ("l2", "ip") else _radius_pairs(qc, metric, radius, prep)
        if near is not None:
            qi, vi = near
            exact = _pairs_exact(qc, v, qi, vi, metric)
            hit = (exact > radius) if larger else (exact < radius)
            qi, vi, exact = rank_pairs(qi[hit], vi[hit], exact[hit], ids, k, larger)
            out_q.append(qi + s)
            out_v.append(vi)
            out_d.append(exact)
            continue
        known = None  # no partner farther than this is asked for
        if radius is not None and not larger:
            known = np.full(len(qc), float(radius))
        elif limit is not None and np.isfinite(limit[s:s + step]).all():
            known = limit[s:s + step]
        d, off, tol = _block(qc, v, metric, vn, v_sel, known)
        if radius is not None:
            edge = (radius - off)[:, None]
            mask = (d > edge - tol[:, None]) if larger else (d < edge + tol[:, None])
        elif known is not None:
            edge = (known - off)[:, None]
            mask = (d >= edge - tol[:, None]) if larger else (d <= edge + tol[:, None])
        elif k >= nv:
            mask = np.ones_like(d, dtype=bool)
        else:
            if larger:
                kth = -np.partition(-d, k - 1, axis=1)[:, k - 1]
                mask = d >= (kth - tol)[:, None]
            else:
                kth = np.partition(d, k - 1, axis=1)[:, k - 1]
                mask = d <= (kth + tol)[:, None]
        qi, vi = np.nonzero(mask)
        exact = _pairs_exact(qc, v, qi, vi, metric)
        if radius is not None:
            hit = (exact > radius) if larger else (exact < radius)
            qi, vi, exact = qi[hit], vi[hit], exact[hit]
        qi, vi, exact = rank_pairs(qi, vi, exact, ids, k, larger)
        out_q.append(qi + s)
        out_v.append(vi)
        out_d.append(exact)
    return np.concatenate(out_q), np.concatenate(out_v), np.concatenate(out_d)


def _radius_pairs(q, metric, radius, prep):
    """Pairs that may be within a radius, by one matrix product in single precision (the norms, the radius and the
    error of the sums are further columns); None where that error would be a large part of the radius."""
    v, vn, dim = prep["v"], prep["vn"], q.shape[1]
    qn = np.einsum("ij,ij->i", q, q)
    with np.errstate(invalid="ignore"):
        size = np.sqrt(qn) * np.sqrt(vn.max()) if metric == "ip" else (np.sqrt(qn) + np.sqrt(vn.max())) ** 2
    error = np.finfo(np.float32).eps * (dim + 8) * (size + abs(radius))
    if not (1e-20 < abs(radius) < 1e20 and error.max() <= 0.01 * abs(radius)):  # also where squares overflow
        return None
    if "single" not in prep:
        ones = np.ones(len(v))
        prep["single"] = np.column_stack((-v, ones, ones) if metric == "ip" else (-2 * v, vn, ones)).astype(np.float32)
    rest = (np.zeros(len(q)), radius - error) if metric == "ip" else (np.ones(len(q)), qn - radius - error)
    s = np.column_stack((q, *rest)).astype(np.float32) @ prep["single"].T
    near = np.flatnonzero(s.reshape(-1) < 0)
    qi = near // len(v)
    return qi, near - qi * len(v)


def _boundable(q, v, metric, vn) -> bool:
    """Whether bounds are worth making: enough items and queries share them."""
    if metric not in bounds.METRICS or not 4 <= q.shape[1] <= 1024 or len(v) < _LEAST or len(q) < 64:
        return False
    return max(float(np.abs(q).max(initial=0.0)), float(vn.max(initial=0.0))) < bounds.LARGEST


def _search_bounded(q, v, ids, metric, k, radius, prep, limit):
    """``search_block`` among the pairs that bounds leave."""
    if radius is not None:
        return _within(q, v, ids, metric, None, radius, prep, np.full(len(q), float(radius)))
    if limit is not None and (limit < bounds.FARTHEST).all():
        return _within(q, v, ids, metric, k, None, prep, limit)
    if 8 * _SEEDS * k > len(v):
        return _search_whole(q, v, ids, metric, k, None, prep, limit)
    return _within(q, v, ids, metric, k, None, prep, _limits(q, v, metric, k))


def _limits(q, v, metric, k):
    """For each query the ``k``-th of the distances to some items, one of each stretch: that nearest by a matrix product."""
    edges = np.linspace(0, len(v), _SEEDS * k + 1).astype(np.int64)
    out = np.empty(len(q))
    step = max(1, _CHUNK_BYTES // (4 * len(v)))
    with np.errstate(over="ignore", invalid="ignore"):  # any choice of items is a right one
        items = np.column_stack((-v, 0.5 * np.einsum("ij,ij->i", v, v))).astype(np.float32)
        for at in range(0, len(q), step):
            qc = q[at:at + step]
            s = np.column_stack((qc, np.ones(len(qc)))).astype(np.float32) @ items.T
            chosen = np.stack([a + s[:, a:b].argmin(axis=1) for a, b in itertools.pairwise(edges.tolist())], axis=1)
            d = _pairs_exact(qc, v, np.repeat(np.arange(len(qc)), chosen.shape[1]), chosen.reshape(-1), metric)
            out[at:at + step] = np.partition(d.reshape(chosen.shape), k - 1, axis=1)[:, k - 1]
    return out


def _left(q, v, qi, vi, limit, prep):
    """Of chosen pairs, those whose L1 distance in single precision may be within the limit."""
    dim = q.shape[1]
    if "rows" not in prep:
        prep["rows"] = v.astype(np.float32)
    rows, qs, ones = prep["rows"], q.astype(np.float32), np.ones(dim, dtype=np.float32)
    error = np.finfo(np.float32).eps * (dim + 4)
    edge, own = limit + error * np.abs(q).sum(axis=1) + 1e-30, error * prep["vn"]
    keep = np.empty(len(qi), dtype=bool)
    step = max(1, PAIR_BYTES // (4 * dim))
    for a in range(0, len(qi), step):
        some, others = qi[a:a + step], vi[a:a + step]
        gap = qs[some]
        gap -= rows[others]
        np.abs(gap, out=gap)
        keep[a:a + step] = gap @ ones <= edge[some] + own[others]
    return qi[keep], vi[keep]


def _within(q, v, ids, metric, k, radius, prep, known):
    """Partners up to each query's ``known`` distance (below the radius), the best ``k`` of each."""
    if "bounds" not in prep:
        prep["bounds"] = bounds.Bounds(v, metric)
    order = np.argsort(known, kind="stable")  # queries of a step share a scale
    found = []
    for at in range(0, len(q), bounds.ROWS):
        rows = order[at:at + bounds.ROWS]
        qc, own = q[rows], known[rows]
        pairs = prep["bounds"].pairs(qc, own)
        if pairs is None:
            qi, vi, d = _search_whole(qc, v, ids, metric, k, radius, prep, own)
        else:
            qi, vi = pairs if metric != "l1" else _left(qc, v, *pairs, own, prep)
            d = _pairs_exact(qc, v, qi, vi, metric)
            hit = d < radius if radius is not None else d <= own[qi]
            qi, vi, d = qi[hit], vi[hit], d[hit]
        found.append((rows[qi], vi, d))
    return rank_pairs(*(np.concatenate(x) for x in zip(*found, strict=True)), ids, k, False)


def group_rows(keys: list[np.ndarray]):
    """Split row positions by the value tuple of integer key columns.

    Yields ``(key_tuple, row_positions)``.  With no key columns, one group.
    """
    if not keys:
        yield (), slice(None)
        return
    n = len(keys[0])
    if n == 0:
        return
    stacked = np.stack([np.asarray(k, dtype=np.int64) for k in keys], axis=1)
    uniq, inverse = np.unique(stacked, axis=0, return_inverse=True)
    inverse = inverse.reshape(-1)
    order = np.argsort(inverse, kind="stable")
    bounds = np.r_[0, np.cumsum(np.bincount(inverse, minlength=len(uniq)))]
    for g in range(len(uniq)):
        yield tuple(int(x) for x in uniq[g]), order[bounds[g]:bounds[g + 1]]
