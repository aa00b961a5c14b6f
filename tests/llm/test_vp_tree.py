import numpy as np
import pytest

from vecspark.llm import vp_tree as V


def brute(rows, k=5, every=50):
    def ok(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in rows if i is not None and ok(v)]
    out = {}
    for qi, q in good:
        if qi % every:
            continue
        found = [(-float(V.cosine(q[None], v[None])[0]), i) for i, v in good if i != qi and len(v) == len(q)]
        out[qi] = [(r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return out


def search(spark, rows, **options):
    vectors = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id bigint, embedding array<float>, tree string, id int")
    got = {}
    for r in V.nearest(vectors, vectors.where("vec_id % 50 = 0"), **options).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return got


def vectors(n=900, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).tolist()) for i in range(n)]
    for i in range(300, 500):  # one very common vector
        rows[i] = (i, rows[300][1])
    rows[100] = (100, rows[300][1])
    rows += [(2000, None), (2050, [float("nan")] * dim), (2100, [0.0] * dim), (2150, [float("inf")] + [1.0] * (dim - 1)),
             (2200, [None] * dim), (2250, [1.0, 2.0]), (2251, [1.0, 2.5]), (None, [1.0] * dim)]
    return rows


def test_exact_search_with_ties_and_unusable_vectors(spark):
    rows = vectors()
    assert search(spark, rows, shard_rows=300, query_block=7) == {k: v for k, v in brute(rows).items() if v}


def test_recall_grows_with_the_factor():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    data = centres[rng.integers(0, 30, 4000)] + 0.3 * rng.normal(size=(4000, 16))
    tree, ids = V.VPTree(np.arange(4000), data, leaf=32), np.arange(4000, 4100)
    queries = centres[rng.integers(0, 30, 100)] + 0.3 * rng.normal(size=(100, 16))
    unit = lambda x: x / np.sqrt((x**2).sum(1))[:, None]
    want = np.argsort(-(unit(queries) @ unit(data).T), axis=1)[:, :5]
    recall, compared = [], []
    for factor in (0.5, 0.8, 1.0):
        run = V._Search(tree, ids, queries, unit(queries), 5, factor)
        run.visit(tree.root, np.arange(100))
        got = [set(run.found[run.row == i]) for i in range(100)]
        recall.append(np.mean([len(g & set(w)) / 5 for g, w in zip(got, want)]))
        compared.append(run.compared)
    assert recall[2] == 1.0 and recall[1] >= 0.9 and recall[0] <= recall[1] <= 1.0
    assert compared[0] < compared[1] < compared[2] < 100 * 4000  # clustered data: even exact search prunes


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_or_no_vectors(spark, n):
    rows = [(50 * i, [1.0, float(i)]) for i in range(n)]
    assert search(spark, rows) == {k: v for k, v in brute(rows).items() if v}


def test_repeated_rows(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows + [rows[10], rows[20], rows[20]], "vec_id bigint, embedding array<double>")
    want = sorted(map(tuple, V.nearest(spark.createDataFrame(rows, df.schema), df.where("vec_id % 10 = 0").distinct(), 5).collect()))
    assert sorted(map(tuple, V.nearest(df, df.where("vec_id % 10 = 0"), 5).collect())) == want
    other = spark.createDataFrame(rows + [(20, rng.normal(size=6).tolist())], df.schema)
    got = V.nearest(other, other.where("vec_id = 20"), 5).groupBy("rank").count().collect()
    assert sorted((r["rank"], r["count"]) for r in got) == [(i, 2) for i in range(1, 6)]


def test_query_blocks_are_never_broadcast(spark):
    """The blocks times the shards are the largest table of the search; as a broadcast they would pass through the driver."""
    rng = np.random.default_rng(8)
    rows = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    found = V.nearest(rows, rows.where("vec_id % 50 = 0"), shard_rows=50)
    assert len(found.collect()) == 40
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()
