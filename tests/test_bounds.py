"""Bounds of the L1 and L-infinity searches: no pair within its limit is left out, and most others are."""

import numpy as np
import pytest

from vecspark.functions import bounds, kernels


def _distances(q, v, metric):
    gap = np.abs(q[:, None, :] - v[None])
    return gap.sum(2) if metric == "l1" else gap.max(2)


def _vectors(kind, rng, n, dim):
    if kind == "normal":
        return rng.normal(size=(n, dim))
    if kind == "whole":  # many ties, many equal rows
        return rng.integers(0, 3, size=(n, dim)).astype(float)
    if kind == "equal":
        return np.full((n, dim), 0.1)
    if kind == "uneven":  # one component large, one constant, some rows far away
        v = rng.normal(size=(n, dim)) * np.where(np.arange(dim) == 1, 1e6, 1.0)
        v[:, 2] = 7.0
        v[rng.random(n) < 0.05] *= 1e9
        return v
    return rng.normal(size=(n, dim)) * 1e-25


@pytest.mark.parametrize("metric", ["l1", "linf"])
@pytest.mark.parametrize("kind", ["normal", "whole", "equal", "uneven", "tiny"])
@pytest.mark.parametrize("dim", [5, 16])
def test_no_near_pair_is_left_out(metric, kind, dim):
    rng = np.random.default_rng(dim)
    v, q = _vectors(kind, rng, 700, dim), _vectors(kind, rng, 75, dim)
    q[:30] = v[:30]
    d = _distances(q, v, metric)
    for limit in (np.partition(d, 4, axis=1)[:, 4], np.zeros(75), np.full(75, np.median(d)), np.full(75, -1.0)):
        pairs = bounds.Bounds(v, metric).pairs(q, limit)
        if pairs is not None:
            assert pairs[0].max(initial=0) < 75 and pairs[1].max(initial=0) < 700
            assert {*zip(*np.nonzero(d <= limit[:, None]))} <= {*zip(*pairs)}


@pytest.mark.parametrize("metric", ["l1", "linf"])
@pytest.mark.parametrize("kind", ["normal", "whole", "equal", "uneven", "tiny"])
@pytest.mark.parametrize("dim", [5, 16])
def test_bounded_searches_equal_a_brute_force(metric, kind, dim):
    rng = np.random.default_rng(dim + 1)
    v, q = _vectors(kind, rng, 700, dim), _vectors(kind, rng, 75, dim)
    q[:30] = v[:30]
    v[3, 1], v[9, 0], q[40, 2] = np.nan, np.inf, np.inf
    ids = rng.permutation(5000)[:700]
    with np.errstate(invalid="ignore"):
        d = _distances(q, v, metric)
    d[~np.isfinite(d)] = np.inf
    order = [np.lexsort((ids, row))[:5] for row in d]
    want = [(i, int(ids[j]), d[i, j]) for i in range(75) if i != 40 for j in order[i]]
    kth = np.array([d[i, row[-1]] for i, row in enumerate(order)])
    for limit in (None, np.where(np.arange(75) == 40, 1.0, kth), np.full(75, 1e20)):
        qi, vi, got = kernels.search_block(q, v, ids, metric, k=5, limit=limit)
        assert [*zip(qi.tolist(), ids[vi].tolist())] == [x[:2] for x in want]
        assert np.allclose(got, [x[2] for x in want], rtol=1e-13, atol=0)
    radius = float(np.median(kth))
    qi, vi, got = kernels.search_block(q, v, ids, metric, radius=radius)
    assert {*zip(qi.tolist(), vi.tolist())} == {*zip(*(x.tolist() for x in np.nonzero(d < radius)))} and (got < radius).all()


@pytest.mark.parametrize("metric", ["l1", "linf"])
def test_few_distances_are_computed(metric, monkeypatch):
    """Of random vectors, the hardest for bounds; all pairs were computed before."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(8000, 64))
    seen, exact, block = [], kernels._pairs_exact, kernels._block
    monkeypatch.setattr(kernels, "_pairs_exact", lambda q, v, qi, *more: (seen.append(len(qi)), exact(q, v, qi, *more))[1])
    monkeypatch.setattr(kernels, "_block", lambda q, v, *more: (seen.append(len(q) * len(v)), block(q, v, *more))[1])
    kernels.search_block(v[:512], v, np.arange(8000), metric, k=10)
    assert sum(seen) < 0.1 * 512 * 8000


def test_a_limit_that_most_are_within_is_not_bounded():
    v = np.random.default_rng(2).normal(size=(600, 8))
    for metric in bounds.METRICS:
        assert bounds.Bounds(v, metric).pairs(v[:64], np.full(64, 1e3)) is None
        assert len(kernels.search_block(v[:64], v, np.arange(600), metric, radius=1e3)[0]) == 64 * 600


@pytest.mark.parametrize("metric", ["l1", "linf"])
def test_boundless_limits(metric):
    v = np.random.default_rng(2).normal(size=(700, 8))
    with np.errstate(invalid="raise", over="raise"):
        for radius in (np.inf, 1e308):
            assert len(kernels.search_block(v[:64], v, np.arange(700), metric, radius=radius)[0]) == 64 * 700
    want = kernels.search_block(v[:64], v, np.arange(700), metric, k=3)
    for limit in (np.full(64, 1e308), np.r_[np.inf, np.full(63, 9.0)]):
        for a, b in zip(want, kernels.search_block(v[:64], v, np.arange(700), metric, k=3, limit=limit), strict=True):
            assert (a == b).all()
