"""The two-level quantizer finds the same lists as a brute assignment."""

import numpy as np
import pytest

from vecspark.functions import cells, kernels
from vecspark.operators import kmeans as km


def _brute(q, v, ids, metric):
    at, pos, _ = kernels.search_block(q, v, ids, metric, k=1)
    out = np.full(len(q), -1, dtype=np.int64)
    out[at] = pos
    return out


def _clustered(rng, n, dim, clusters=64, spread=0.05):
    return rng.normal(size=(clusters, dim))[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, dim))


@pytest.mark.parametrize("metric", ["l2", "l1", "linf"])
@pytest.mark.parametrize("kind", ["clustered", "plain", "ties"])
def test_same_as_brute(metric, kind):
    rng = np.random.default_rng(11)
    if kind == "clustered":
        v, q = np.split(_clustered(rng, 4000, 8), [1500])
    elif kind == "plain":
        v, q = rng.normal(size=(1500, 8)), rng.normal(size=(800, 8))
    else:  # repeated centroids and vectors halfway between them
        v, q = rng.integers(0, 3, (1500, 6)).astype(float), rng.integers(0, 6, (900, 6)) / 2
    ids = rng.permutation(len(v))
    near = cells.Nearest(v, ids, metric, cells.layout(v, metric))
    assert near.cells is not None
    assert (ids[near.search(q)] == ids[_brute(q, v, ids, metric)]).all()


def test_few_distances_among_4096_clustered_centroids():
    rng = np.random.default_rng(2)
    v, q = np.split(_clustered(rng, 4096 + 5000, 64), [4096])
    ids = np.arange(4096)
    near = cells.Nearest(v, ids, "l2", cells.layout(v, "l2"))
    assert (near.search(q) == _brute(q, v, ids, "l2")).all()
    assert near.compared < len(q) * len(v) / 10


def test_vectors_without_distance_and_layouts_not_used():
    rng = np.random.default_rng(4)
    v, q = rng.normal(size=(1200, 4)), rng.normal(size=(30, 4))
    q[3, 1], q[7, 0] = np.nan, np.inf
    near = cells.Nearest(v, np.arange(1200), "l2", cells.layout(v, "l2"))
    found = near.search(q)
    assert (found == _brute(q, v, np.arange(1200), "l2")).all() and found[3] == found[7] == -1
    assert len(near.search(q[:0])) == 0
    assert cells.layout(v, "ip") is None and cells.layout(v[:500], "l2") is None
    same = np.ones((1100, 3))
    assert cells.Nearest(same, np.arange(1100), "l2", cells.layout(same, "l2")).search(same[:2]).tolist() == [0, 0]


def test_k_means_by_cells_equals_k_means(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(int(i), x.tolist()) for i, x in enumerate(_clustered(rng, 900, 6, 12))]
    train = spark.createDataFrame(rows, "_id long, _v array<double>").repartition(3)

    def built():
        cents = km.kmeans(train, dim=6, nlist=40, iterations=3)
        lists = km.assign_lists(train, cents, dim=6, metric="l2", centroid_rows=40)
        return ({r["list_id"]: tuple(r["centroid"]) for r in cents.collect()},
                {r["_id"]: r["list_id"] for r in lists.select("_id", "list_id").collect()})

    plain = built()
    monkeypatch.setattr(cells, "LEAST", 20)  # the layout is made on the driver
    assert built() == plain
