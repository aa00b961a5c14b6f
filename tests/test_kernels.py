"""Block kernels against brute force (no Spark)."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vecspark.functions import kernels


def brute(q, v, ids, metric, k=None, radius=None):
    out = []
    for i in range(len(q)):
        if metric == "l2":
            d = ((q[i] - v) ** 2).sum(1)
        elif metric == "ip":
            d = (q[i] * v).sum(1)
        elif metric == "l1":
            d = np.abs(q[i] - v).sum(1)
        else:
            d = np.abs(q[i] - v).max(1)
        larger = metric == "ip"
        order = np.lexsort((ids, -d if larger else d))
        if radius is not None:
            order = [j for j in order if (d[j] > radius if larger else d[j] < radius)]
        else:
            order = order[:k]
        out += [(i, ids[j], d[j]) for j in order]
    return out


@settings(max_examples=40, deadline=None)
@given(nq=st.integers(1, 7), nv=st.integers(1, 40), dim=st.integers(1, 6), k=st.integers(1, 12),
       metric=st.sampled_from(["l2", "ip", "l1", "linf"]), seed=st.integers(0, 10_000),
       ties=st.booleans())
def test_search_block_matches_brute_force(nq, nv, dim, k, metric, seed, ties):
    rng = np.random.default_rng(seed)
    v = rng.integers(-3, 4, size=(nv, dim)).astype(float) if ties else rng.normal(size=(nv, dim))
    q = rng.integers(-3, 4, size=(nq, dim)).astype(float) if ties else rng.normal(size=(nq, dim))
    ids = rng.permutation(1000)[:nv].astype(np.int64)
    qi, vi, d = kernels.search_block(q, v, ids, metric, k=k)
    got = [(int(a), int(ids[b]), float(c)) for a, b, c in zip(qi, vi, d)]
    exp = brute(q, v, ids, metric, k=k)
    assert [(a, b) for a, b, _ in got] == [(a, int(b)) for a, b, _ in exp]
    assert np.allclose([c for *_, c in got], [c for *_, c in exp])


@settings(max_examples=30, deadline=None)
@given(nq=st.integers(1, 5), nv=st.integers(1, 30), metric=st.sampled_from(["l2", "ip", "l1", "linf"]),
       seed=st.integers(0, 10_000), radius=st.floats(0.1, 8.0))
def test_range_block_matches_brute_force(nq, nv, metric, seed, radius):
    rng = np.random.default_rng(seed)
    v, q = rng.normal(size=(nv, 4)), rng.normal(size=(nq, 4))
    ids = np.arange(nv, dtype=np.int64)
    qi, vi, d = kernels.search_block(q, v, ids, metric, radius=radius)
    got = [(int(a), int(ids[b])) for a, b in zip(qi, vi)]
    assert got == [(a, int(b)) for a, b, _ in brute(q, v, ids, metric, radius=radius)]


def test_exact_distance_for_identical_vectors():
    v = np.array([[1e5, 1e5 + 1, 3.0]])
    qi, vi, d = kernels.search_block(v.copy(), v, np.array([7]), "l2", k=1)
    assert d[0] == 0.0


def test_list_matrix_rejects_bad_sizes():
    col = pa.array([[1.0, 2.0], [3.0]], type=pa.list_(pa.float32()))
    with pytest.raises(ValueError):
        kernels.list_matrix(col, 2)
    with pytest.raises(ValueError):
        kernels.list_matrix(pa.array([[1.0, None]], type=pa.list_(pa.float32())), 2)


def test_group_rows():
    a = np.array([3, 1, 3, 2])
    b = np.array([0, 0, 0, 1])
    groups = dict((k, sorted(r.tolist())) for k, r in kernels.group_rows([a, b]))
    assert groups == {(1, 0): [1], (2, 1): [3], (3, 0): [0, 2]}
