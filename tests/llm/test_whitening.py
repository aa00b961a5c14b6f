import numpy as np
import pytest

from vecspark.llm import whitening as w


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    v = (q * np.array(values, dtype=float)) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize("values", [[5.0], [3, 2, 1], [2, 2, 2, 1], [1e6, 1, 1e-3, 0, 0], [4, 4 * (1 + 1e-9), 1, 1e-8], list(range(1, 41))])
def test_counts_and_leading_eigenpairs(values):
    v, falling = symmetric(values, len(values)), sorted(map(float, values), reverse=True)
    for s in (0.5, 1.5, 3.999, 39.5, 1e5):
        assert w.count_above(v, s) == sum(x > s for x in falling)
    found = w.leading(v, 32)
    rank = sum(x > 1e-12 * falling[0] for x in falling)
    assert len(found.values) == min(32, rank)
    assert np.allclose(found.values, falling[:len(found.values)], rtol=0, atol=1e-11 * falling[0])
    assert np.abs(found.vectors @ found.vectors.T - np.eye(len(found.vectors))).max() < 1e-10
    assert np.abs(v @ found.vectors.T - found.vectors.T * found.values).max() < 1e-9 * falling[0]


def test_indefinite_matrices_need_two_by_two_pivots():
    v = np.array([[0.0, 1, 0], [1, 0, 0], [0, 0, 0]])
    assert w.count_above(v, 0.0) == 1 and w.count_above(v, -0.5) == 2 and w.count_above(v, 2.0) == 0


def test_query_is_whitening_by_a_library_decomposition(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.floor(np.array([r["embedding"] for r in rows], dtype=float) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:32], u[:, ::-1][:, :32]
    want = c @ u / np.sqrt(e)
    found = w.op12_whitening(spark, sf).toPandas()
    got = found.pivot(index="vec_id", columns="component", values="whitened").loc[[r["vec_id"] for r in rows]].to_numpy()
    assert got.shape == want.shape and np.abs(got - want * np.sign((got * want).sum(0))).max() < 1e-8
    one = found[found.component == 1].set_index("vec_id").loc[[r["vec_id"] for r in rows]]
    assert (one.deviation.to_numpy() == ((n * x - s) ** 2).sum(1)).all() and (found.n == n).all()
    shares = found.groupby("component").explained.first().to_numpy()
    assert np.allclose(shares, e / np.trace(c.T @ c / n), rtol=1e-10) and found.identity_error.max() < 1e-10


def test_odd_rows(spark):
    schema = "vec_id bigint, embedding array<float>, row string, deviation string"
    rows = [(1, [0.5, 1.0, 0.0]), (1, [0.5, 1.0, 0.0]), (2, None), (3, [float("nan"), 0.0, 0.0]), (4, [1.0]), (None, [2.0, 1.0, 0.0]),
            (5, []), (6, [1.0, None, 2.0]), (7, [1e30, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "a", "b") for i, v in rows], schema)
    kept = w.usable(df, "embedding", ["vec_id"])
    model = w.fit(kept)
    assert model.n == 3 and len(model.spectrum.values) == 1 and w.identity_error(kept, model) < 1e-12
    out = sorted(((r["vec_id"], r["deviation"], round(abs(r["whitened"][0]), 9)) for r in w.whiten(kept, model).collect()), key=repr)
    assert [o[0] for o in out] == [1, 1, None] and out[0] == out[1] and out[0][1] == 96**2
    for few in ([], rows[:2], rows[2:4]):
        model = w.fit(w.usable(spark.createDataFrame([(i, v, "a", "b") for i, v in few], schema), "embedding", ["vec_id"]))
        assert model is None or len(model.spectrum.values) == 0


def test_deviations_beyond_a_bigint_are_null():
    model = w.Whitening(10**10, (0, 0), 1.0, w.Spectrum(np.ones(1), np.ones((1, 2))), 64, 0)
    assert model.deviations(np.array([[1, 2], [0, 0]])) == [None, 0]
    assert model.deviations(np.array([[0, 0]])) == [0]
