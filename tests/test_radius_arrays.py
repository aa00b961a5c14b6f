"""Array form of a radius search: hits leave their tasks as arrays and meet their query's row once."""

import numpy as np
import pytest

import vecspark as vs
from vecspark.functions import kernels
from vecspark.operators import nearest as nn


def _vectors(spark, n, dim=8, seed=1):
    values = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    values[n // 2] = values[0]
    return values, spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(values)], "id long, vector array<float>")


def _distances(q, v, metric):
    q, v = q.astype(np.float64), v.astype(np.float64)
    return np.stack([kernels.pair_exact(np.repeat(x[None], len(v), 0), v, metric) for x in q])


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hits_are_not_rows_of_a_shuffle(spark):
    _, emb = _vectors(spark, 60)
    found = vs.range_search_arrays(vs.build_index(emb, 8), emb, 4.0, strategy="tiled")
    plan = _plan(found)
    assert "collect_list" not in plan and "Aggregate" not in plan and "Join" not in plan


@pytest.mark.parametrize("strategy", ["tiled", "broadcast_queries", "broadcast_items"])
@pytest.mark.parametrize("metric, radius", [("l2", 9.0), ("ip", 1.5), ("l1", 6.0)])
def test_arrays_equal_a_brute_force(spark, strategy, metric, radius, monkeypatch):
    """Few rows a batch: a query's arrays come in several batches."""
    monkeypatch.setattr(nn, "TILE_PAIRS", 1000)
    values, emb = _vectors(spark, 120)
    far = spark.createDataFrame([(7, [99.0] * 8), (None, [0.0] * 8)], "id long, vector array<float>")  # an id twice; hits of none
    asked = emb.unionAll(far.where("id is not null"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for keep in (True, False):
            got = vs.range_search_arrays(vs.build_index(emb, 8, metric=metric), asked, radius, strategy=strategy, preserve_vector=keep)
            assert got.columns == ["query_vector", "query_idx", "vector_idxs", "distances"]
            rows = got.collect()
            assert len(rows) == 121
            q = np.concatenate((values, np.full((1, 8), 99, np.float32)))
            d, larger = _distances(q, values, metric), metric == "ip"
            want = []
            for at, row in enumerate(d):
                hit = np.flatnonzero(row > radius if larger else row < radius)
                hit = hit[np.lexsort((hit, -row[hit] if larger else row[hit]))]
                want.append((at if at < 120 else 7, q[at].tolist() if keep else None, hit.tolist(), row[hit].astype(np.float32)))
            key = lambda r: (r[0], len(r[2]), r[2])
            for a, b in zip(sorted(((r.query_idx, r.query_vector, r.vector_idxs, r.distances) for r in rows), key=key),
                            sorted(want, key=key), strict=True):
                assert a[:3] == b[:3] and np.allclose(a[3], b[3], rtol=1e-6)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_probed_lists_and_no_ids(spark):
    values, emb = _vectors(spark, 120)
    index = vs.build_index(emb, 8, "ivf_flat", nlist=4, iterations=2)
    got = vs.range_search_arrays(index, emb, 9.0, id_col=None, nprobe=4, preserve_vector=True).collect()
    d = _distances(values, values, "l2")
    assert sorted((r.query_idx, sorted(r.vector_idxs)) for r in got if r.query_idx is None) == sorted(
        (None, np.flatnonzero(row < 9.0).tolist()) for row in d)
    none = vs.range_search_arrays(vs.build_index(emb, 8), emb, -1.0).collect()
    assert len(none) == 120 and all(r.vector_idxs == [] and r.distances == [] for r in none)
    assert vs.range_search_arrays(vs.build_index(emb, 8), emb.limit(0), 9.0).count() == 0


def test_arrays_leave_a_task_in_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(nn, "GATHER_AT", 10)
    rng = np.random.default_rng(6)
    batches = [nn._batch([], rng.integers(0, 5, 6), rng.integers(0, 99, 6), rng.random(6), np.zeros(6), [], {}) for _ in range(7)]
    parts = list(nn._gathered(iter(batches)))
    assert len(parts) == 4 and max(sum(map(len, p.column("_ids").to_pylist())) for p in parts) == 12
    want = sorted((r["_qid"], r["_id"], r["_d"]) for r in pa.Table.from_batches(batches).to_pylist())
    assert sorted((r["_qid"], *x) for r in pa.Table.from_batches(parts).to_pylist() for x in zip(r["_ids"], r["_ds"])) == want


@pytest.mark.parametrize("metric", ["l2", "ip"])
@pytest.mark.parametrize("shift, scale", [(0.0, 1.0), (1000.0, 1.0), (0.0, 1e-25), (0.0, 1e25), (0.0, 1e-9)])
def test_single_precision_loses_no_pair(metric, shift, scale):
    rng = np.random.default_rng(9)
    v = (rng.normal(size=(300, 16)) + shift) * scale
    q = v[:80]
    d = _distances(q, v, metric)
    for radius in (float(np.quantile(d, 0.1)), float(d[0, 5]), float(np.nextafter(d[0, 5], np.inf)), 0.0, -1.0):
        qi, vi, got = kernels.search_block(q, v, np.arange(300), metric, radius=radius)
        want = np.nonzero(d > radius if metric == "ip" else d < radius)
        assert {*zip(qi.tolist(), vi.tolist())} == {*zip(*(x.tolist() for x in want))} and (got == d[qi, vi]).all()


def test_radius_searches_use_single_precision_where_it_is_sharp(monkeypatch):
    v = np.random.default_rng(9).normal(size=(300, 16))
    monkeypatch.setattr(kernels, "_block", lambda *a: pytest.fail("a matrix in double precision was made"))
    for metric in ("l2", "ip"):
        assert len(kernels.search_block(v[:80], v, np.arange(300), metric, radius=8.0)[0])


def test_squares_that_overflow_lose_no_pair():
    q, v = np.full((3, 4), 1e200), np.zeros((5, 4))
    with np.errstate(all="ignore"):
        assert len(kernels.search_block(q, v, np.arange(5), "ip", radius=-1.0)[0]) == 15
