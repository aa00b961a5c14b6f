"""

Index bytes are not comparable; T2-T6 check the facts those bytes encode.
Search results are checked against the golden output and against brute force.
"""

import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

import vecspark as vs
from vecspark.sources import tables

# Golden results of the reference's regression output.
T7_QUERY_0 = ([0, 10, 20, 30, 40], [2.5, 902.5, 3802.5, 8702.5, 15602.5])
T7_QUERY_10005 = ([10010, 10000, 10020, 9990, 10030], [202.5, 302.5, 2102.5, 2402.5, 6002.5])
T7_QUERY_20010 = ([20010, 20020, 20000, 20030, 19990], [2.5, 902.5, 1102.5, 3802.5, 4202.5])
T9_HITS = {0: [0], 20010: [20010], 40020: [40020], 60030: [60030], 80040: [80040]}
T10 = ([0, 3, 6, 7, 9], [100.0, 103.0, 106.0, 107.0, 109.0])
T12 = ([0, 30, 60, 90, 120], [2.5, 8702.5, 35402.5, 80102.5, 142802.5])
SINGLE_QUERY = [0.5, 1.5, 2.5, 3.5, 4.5, 5.5, 6.5, 7.5, 8.5, 9.5]


def expected_knn(k=5):
    """Brute force over the fixture rule (vector = id..id+9, query = id+0.5..id+9.5)."""
    ids = np.arange(0, 100000, 10)
    out = {}
    for q in range(0, 100000, 10005):
        d = 10 * (q + 0.5 - ids) ** 2
        order = np.lexsort((ids, d))[:k]
        out[q] = (ids[order].tolist(), d[order].tolist())
    return out


@pytest.fixture(scope="module")
def queried(spark):
    return tables.vector_queried(spark).cache()


@pytest.fixture(scope="module")
def query(spark):
    return tables.vector_query(spark).cache()


def test_t1_pack(spark):
    row = vs.pack_vectors(tables.small_pack_input(spark)).collect()
    assert len(row) == 1
    assert row[0]["ids"] == list(range(0, 100, 10))
    assert row[0]["vectors"] == [float(x) for x in range(100)]
    only_vectors = vs.array_1d_extend(tables.small_pack_input(spark)).first()["vectors"]
    assert only_vectors == [float(x) for x in range(100)]


def test_t2_create(spark):
    idx = vs.create_index(spark, 10)
    assert idx.dim == 10 and idx.spec.kind == "flat" and idx.metric == "l2"
    assert vs.count_vectors(idx) == 0
    with pytest.raises(ValueError):
        vs.create_index(spark, -10)
    with pytest.raises(ValueError):
        vs.create_index(spark, 10, metric=7)


def test_t3_train_ivfpq(spark):
    packed = tables.training_ramp(spark)
    train = vs.unpack_vectors(packed, 10, ids_col=None, vectors_col="vectors")
    assert train.count() == 256
    idx = vs.create_index(spark, 10, "ivf_pq", nlist=16, m=5, ks=256, iterations=2)
    idx = vs.train_index(idx, train)
    assert idx.trained
    cents = idx.centroids.collect()
    assert len(cents) == 16 and all(len(r["centroid"]) == 10 for r in cents)
    books = idx.codebooks.groupBy("sub").agg(F.count(F.lit(1)).alias("n"),
                                             F.max(F.size("centroid")).alias("d")).collect()
    assert sorted((r["sub"], r["n"], r["d"]) for r in books) == [(s, 256, 2) for s in range(5)]
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        assert vs.train_index(idx, train) is idx
        assert any("already trained" in str(w.message) for w in caught)


def test_t4_add_one_vector(spark):
    one = spark.createDataFrame([(1, [float(x) for x in range(10)])], "id long, vector array<float>")
    idx = vs.add_vectors(vs.create_index(spark, 10), one)
    rows = idx.postings.collect()
    assert [(r["id"], list(r["vector"])) for r in rows] == [(1, [float(x) for x in range(10)])]


def test_t5_options(spark):
    idx = vs.set_options(vs.create_index(spark, 10), nprobe=8)
    assert idx.options.nprobe == 8
    with pytest.raises(ValueError):
        vs.set_options(idx, search_depth=80)
    with pytest.raises(ValueError):
        vs.set_options(idx, nprobe=0)


def test_t6_reset(spark):
    one = spark.createDataFrame([(1, [float(x) for x in range(10)])], "id long, vector array<float>")
    base = vs.create_index(spark, 10)
    idx = vs.reset_index(vs.add_vectors(base, one))
    assert vs.count_vectors(idx) == 0
    assert idx.spec == base.spec and idx.options == base.options


def test_t7_build_and_search_long_form(spark, queried, query):
    idx = vs.build_index(queried, 10, "flat", nprobe=1)
    got = vs.knn(idx, query, 5).orderBy("query_idx", "ranking").collect()
    assert len(got) == 50
    exp = expected_knn()
    for q, (ids, ds) in exp.items():
        rows = [r for r in got if r["query_idx"] == q]
        assert [r["vector_idx"] for r in rows] == ids
        assert np.allclose([r["distance"] for r in rows], ds)
    assert exp[0] == T7_QUERY_0 and exp[10005] == T7_QUERY_10005 and exp[20010] == T7_QUERY_20010


def test_t8_array_form_preserving_vectors(spark, queried, query):
    idx = vs.add_vectors(vs.create_index(spark, 10), queried)
    got = {r["query_idx"]: r for r in vs.search(idx, query, 5, preserve_vector=True).collect()}
    assert len(got) == 10
    assert got[0]["query_vector"] == SINGLE_QUERY
    assert got[0]["vector_idxs"] == T7_QUERY_0[0]
    assert got[0]["distances"] == pytest.approx(T7_QUERY_0[1])
    assert got[10005]["vector_idxs"] == T7_QUERY_10005[0]
    for q, (ids, ds) in expected_knn().items():
        assert got[q]["vector_idxs"] == ids


@pytest.mark.parametrize("kind,nprobe", [("flat", 1), ("ivf_flat", 32)])
def test_t9_range_search_with_empty_results(spark, queried, query, kind, nprobe):
    idx = vs.build_index(queried, 10, kind, nlist=32 if kind != "flat" else 1, iterations=3, nprobe=nprobe)
    got = vs.range_search_arrays(idx, query, 100.0, preserve_vector=False).collect()
    assert len(got) == 10
    for r in got:
        assert r["query_vector"] is None
        assert r["vector_idxs"] == T9_HITS.get(r["query_idx"], [])
        assert r["distances"] == ([2.5] if r["query_idx"] in T9_HITS else [])


def test_t9_ivf_single_probe(spark, queried, query):
    """With one probed list the hits are those of the full search whose list is the query's nearest."""
    idx = vs.build_index(queried, 10, "ivf_flat", nlist=32, iterations=3)
    lists = {r["list_id"]: r["centroid"] for r in idx.centroids.collect()}
    stored = {r["id"]: r["list_id"] for r in idx.postings.collect()}
    got = {r["query_idx"]: r["vector_idxs"] for r in vs.range_search_arrays(idx, query, 100.0).collect()}
    for r in query.collect():
        near = min(lists, key=lambda k: (sum((a - b) ** 2 for a, b in zip(r["vector"], lists[k])), k))
        assert got[r["id"]] == [x for x in T9_HITS.get(r["id"], []) if stored[x] == near]
    assert any(got.values())


def test_t10_topk_merge(spark):
    got = vs.topk_merge(tables.merge_input(spark), 5).collect()
    assert len(got) == 1
    assert got[0]["idxs"] == T10[0] and got[0]["distances"] == T10[1]


def test_topk_merge_null_and_empty_rules(spark):
    df = spark.createDataFrame([(1, [], []), (2, [5], [1.0]), (2, [6, 7], [0.5, 2.0])],
                               "g int, idxs array<long>, distances array<float>")
    got = {r["g"]: r for r in vs.topk_merge(df, 2, by=["g"]).collect()}
    assert got[1]["idxs"] is None
    assert got[2]["idxs"] == [6, 5]
    bad = spark.createDataFrame([(1, [1, 2], [1.0])], "g int, idxs array<long>, distances array<float>")
    with pytest.raises(Exception):
        vs.topk_merge(bad, 2, by=["g"]).collect()


@pytest.fixture(scope="module")
def sharded(spark, queried):
    return vs.build_index(queried, 10, "ivf_flat", nlist=1, iterations=2, shard=(F.col("id") % 30).cast("int"))


def test_t11_sharded_build(sharded):
    keys = sharded.extra["groups"], sorted(r["shard_id"] for r in vs.index_keys(sharded).collect())
    assert keys == (3, [0, 10, 20])


def _single_query(spark):
    return spark.createDataFrame([(SINGLE_QUERY,)], "vector array<float>")


def test_t12_keyed_search_without_ids(spark, sharded):
    key = vs.index_keys(sharded).where("shard_id = 0").first()["index_key"]
    got = vs.search(sharded, _single_query(spark), 5, id_col=None, index_key=key).collect()
    assert len(got) == 1
    assert got[0]["query_idx"] is None
    assert got[0]["query_vector"] == SINGLE_QUERY
    assert got[0]["vector_idxs"] == T12[0]
    assert got[0]["distances"] == pytest.approx(T12[1])


def test_t13_keyed_range_search(spark, sharded):
    key = vs.index_keys(sharded).where("shard_id = 0").first()["index_key"]
    got = vs.range_search_arrays(sharded, _single_query(spark), 100.0, id_col=None, index_key=key).collect()
    assert [(r["vector_idxs"], r["distances"]) for r in got] == [([0], [2.5])]


def test_t14_sharded_search_then_merge(spark, sharded, query):
    local = vs.knn(sharded, query, 5, scope="shard")
    lists = local.groupBy("query_idx", "shard_id").agg(
        F.array_sort(F.collect_list(F.struct("ranking", "vector_idx", "distance"))).alias("s")).select(
        "query_idx", F.expr("transform(s, x -> x.vector_idx)").alias("idxs"),
        F.expr("transform(s, x -> cast(x.distance as float))").alias("distances"))
    merged = vs.rank_lists(lists, 5, by=["query_idx"]).orderBy("query_idx", "ranking").collect()
    assert len(merged) == 50
    for q, (ids, ds) in expected_knn().items():
        rows = [r for r in merged if r["query_idx"] == q]
        assert [r["idx"] for r in rows] == ids
        assert [r["ranking"] for r in rows] == [1, 2, 3, 4, 5]
        assert np.allclose([r["distance"] for r in rows], ds)
    glob = vs.knn(sharded, query, 5, scope="global").orderBy("query_idx", "ranking").collect()
    assert [(r["query_idx"], r["vector_idx"]) for r in glob] == [(r["query_idx"], r["idx"]) for r in merged]


def test_aggregates_over_nothing_are_null(spark):
    none = spark.createDataFrame([], "id long, vector array<float>")
    row = vs.pack_vectors(none, page_size=None).collect()
    assert len(row) == 1 and row[0]["ids"] is None and row[0]["vectors"] is None
    assert vs.pack_vectors(none).count() == 0
    lists = spark.createDataFrame([([], [])], "idxs array<long>, distances array<float>")
    got = vs.topk_merge(lists, 3).collect()
    assert len(got) == 1 and got[0]["idxs"] is None and got[0]["distances"] is None


def test_t12_with_a_packed_query_and_no_ids(spark, sharded):
    key = vs.index_keys(sharded).where("shard_id = 0").first()["index_key"]
    packed = spark.createDataFrame([(SINGLE_QUERY,)], "vectors array<float>")
    got = vs.search_packed(sharded, packed, 5, ids_col=None, index_key=key).collect()
    assert len(got) == 1 and got[0]["query_idx"] is None
    assert got[0]["vector_idxs"] == T12[0]
    ranged = vs.range_search_packed(sharded, packed, 100.0, ids_col=None, index_key=key).collect()
    assert [(r["vector_idxs"], r["distances"]) for r in ranged] == [([0], [2.5])]
