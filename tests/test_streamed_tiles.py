"""Tiles whose items stream past a held query tile: what is broadcast, cut, shuffled and kept."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import vecspark as vs
from vecspark.functions import kernels
from vecspark.operators import nearest as nn


def _vectors(spark, n, dim=8, seed=1):
    values = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    return values, spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(values)], "id long, vector array<float>")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_that_grow_are_not_broadcast(spark):
    rows = spark.range(40_000)
    assert nn.choose_strategy(rows, rows, 64, nn.DEFAULT_BROADCAST_BYTES, hits=10)[0] == "tiled"


@pytest.mark.parametrize("metric", ["l2", "ip", "l1", "linf"])
def test_large_work_is_cut_for_more_tasks(spark, metric, monkeypatch):
    monkeypatch.setattr(nn, "TILE_PAIRS", 1000)
    values, emb = _vectors(spark, 300)
    spark.conf.set("vecspark.tile.stats", "true")
    try:
        got = vs.knn(vs.build_index(emb, 8, metric=metric), emb, 5, strategy="tiled").collect()
    finally:
        spark.conf.unset("vecspark.tile.stats")
    assert nn.last_tile_stats()[0] >= 2 * spark.sparkContext.defaultParallelism
    whole = values.astype(np.float64)
    for at in range(300):
        d = kernels.pair_exact(np.repeat(whole[at:at + 1], 300, 0), whole, metric)
        want = np.lexsort((np.arange(300), -d if metric == "ip" else d))[:5]
        assert [r["vector_idx"] for r in sorted((r for r in got if r["query_idx"] == at), key=lambda r: r["ranking"])] == want.tolist()


def test_hits_of_a_radius_search_leave_their_task_for_good(spark):
    """They carry their query's label: no join, and no exchange after the search."""
    _, emb = _vectors(spark, 200)
    found = vs.range_search(vs.build_index(emb, 8), emb, 2.0, strategy="tiled")
    plan = _plan(found)
    assert "Join" not in plan and "Exchange" not in plan[:plan.index("MapInArrow")]
    whole = vs.range_search(vs.build_index(emb, 8), emb, 2.0, strategy="broadcast_queries")
    assert found.count() == whole.count() and found.select("query_idx", "vector_idx").exceptAll(
        whole.select("query_idx", "vector_idx")).isEmpty()


def test_codes_are_shuffled_as_codes(spark):
    _, emb = _vectors(spark, 200)
    idx = vs.build_index(emb, 8, "ivf_pq", nlist=2, m=4, ks=4, iterations=2, nprobe=2)
    found = vs.knn(idx, emb, 3, strategy="tiled")
    assert "code" in _plan(found)
    other = vs.knn(idx, emb, 3, strategy="broadcast_items")
    columns = ["query_idx", "vector_idx", "ranking"]
    assert sorted(found.select(*columns).collect()) == sorted(other.select(*columns).collect())


@pytest.mark.parametrize("metric", ["l1", "linf"])
@pytest.mark.parametrize("scale", [1.0, 1e-20, 1e35])
def test_sums_that_end_early_lose_nothing(metric, scale):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(500, 64)) * np.where(rng.random(500) < 0.9, 100, 1)[:, None] * scale
    q, ids = v[:60] + 0.01 * scale, np.arange(500)
    d = np.array([kernels.pair_exact(np.repeat(x[None], 500, 0), v, metric) for x in q])
    want = np.sort(d, axis=1)[:, :4]
    first = kernels.search_block(q, v, ids, metric, k=4)
    again = kernels.search_block(q, v, ids, metric, k=4, limit=want[:, -1])
    for qi, vi, got in (first, again):
        assert (got.reshape(60, 4) == want).all() and (d[qi, vi] == got).all()
    near = kernels.search_block(q, v, ids, metric, radius=float(want[0, -1]))
    assert len(near[0]) == (d < want[0, -1]).sum()


def test_the_best_of_many_batches():
    rng = np.random.default_rng(5)
    best, parts = nn._Best(np.full(20, np.inf), 3, False), []
    for _ in range(6):
        part = rng.integers(0, 20, 30), rng.permutation(1000)[:30], rng.integers(0, 5, 30).astype(float)
        parts.append(part)
        best.add((), *part)
    qpos, ids, d = (np.concatenate(x) for x in zip(*parts))
    (_, got_q, got_ids, got_d, ranks), = best.results()
    for at in range(20):
        own = sorted(zip(d[qpos == at], ids[qpos == at]))[:3]
        assert own == list(zip(got_d[got_q == at], got_ids[got_q == at])) and ranks[got_q == at].tolist() == list(range(1, len(own) + 1))
        if len(own) == 3:
            assert best.limit(())[at] == own[-1][0]
