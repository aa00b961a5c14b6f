
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

import vecspark as vs
from vecspark.operators import nearest as nn
from vecspark.sources.tables import embeddings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def emb(spark):
    return embeddings(spark, SF).cache()


@pytest.fixture(scope="module")
def brute(emb):
    rows = emb.orderBy("id").collect()
    ids = np.array([r["id"] for r in rows])
    v = np.array([r["vector"] for r in rows], dtype=np.float64)
    d = ((v[:, None, :] - v[None, :, :]) ** 2).sum(-1)
    return ids, v, d


def _pairs(df):
    return sorted((r["query_idx"], r["vector_idx"], round(r["distance"], 6), r["ranking"]) for r in df.collect())


@pytest.mark.parametrize("strategy", ["broadcast_items", "broadcast_queries", "tiled"])
def test_strategies_agree_with_brute_force(spark, emb, brute, strategy):
    ids, _, d = brute
    spark.conf.set("vecspark.tile.bytes", str(40 * (8 * 64 + 16)))  # 40 vectors per tile
    try:
        idx = vs.build_index(emb, 64)
        got = _pairs(vs.knn(idx, emb, 7, strategy=strategy))
    finally:
        spark.conf.unset("vecspark.tile.bytes")
    exp = []
    for i, q in enumerate(ids):
        order = np.lexsort((ids, d[i]))[:7]
        exp += [(int(q), int(ids[j]), round(float(d[i, j]), 6), r + 1) for r, j in enumerate(order)]
    assert got == sorted(exp)


def test_tiled_plan_splits_a_hot_list(spark, emb, brute):
    """One list holding most rows is cut into tiles; results stay exact."""
    ids, _, d = brute
    hot = emb.withColumn("list_id", F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 3 + 1).cast("int"))
    items = hot.select(F.lit(0).alias("shard_id"), "list_id", F.col("id").alias("_id"), F.col("vector").alias("_v"))
    queries = hot.select(F.lit(0).alias("shard_id"), "list_id", F.col("id").alias("_qid"), F.col("vector").alias("_qv"))
    spark.conf.set("vecspark.tile.bytes", str(50 * (8 * 64 + 16)))
    spark.conf.set("vecspark.tile.stats", "true")
    try:
        got = nn.nearest(queries, items, dim=64, metric="l2", k=3, join_keys=["shard_id", "list_id"],
                         strategy="tiled").collect()
    finally:
        spark.conf.unset("vecspark.tile.bytes")
        spark.conf.unset("vecspark.tile.stats")
    tiles, max_items, max_queries = nn.last_tile_stats()
    # the hot list (70% of rows) is cut into many tiles; no tile is far above the 50-row target
    assert tiles >= 49 and max_items <= 100 and max_queries <= 100
    lists = {r["id"]: r["list_id"] for r in hot.select("id", "list_id").collect()}
    pos = {int(x): i for i, x in enumerate(ids)}
    for r in got:
        i = pos[r["_qid"]]
        same = np.array([lists[int(x)] == lists[r["_qid"]] for x in ids])
        dd = np.where(same, d[i], np.inf)
        best = [int(ids[j]) for j in np.lexsort((ids, dd))[:3]]
        assert r["_id"] in best
    assert len(got) == 3 * len(ids)


def test_ivf_with_all_lists_equals_flat(spark, emb):
    flat = _pairs(vs.knn(vs.build_index(emb, 64), emb, 5))
    ivf = vs.build_index(emb, 64, "ivf_flat", nlist=6, iterations=3)
    assert _pairs(vs.knn(ivf, emb, 5, nprobe=6)) == flat


def test_recall_grows_with_nprobe(spark, emb):
    flat = {(q, v) for q, v, *_ in _pairs(vs.knn(vs.build_index(emb, 64), emb, 10))}
    ivf = vs.build_index(emb, 64, "ivf_flat", nlist=8, iterations=3)
    recalls = []
    for p in (1, 2, 4, 8):
        got = {(q, v) for q, v, *_ in _pairs(vs.knn(ivf, emb, 10, nprobe=p))}
        recalls.append(len(got & flat) / len(flat))
    assert recalls == sorted(recalls) and recalls[-1] == 1.0 and recalls[0] < 1.0


def test_sharded_merge_equals_unsharded(spark, emb):
    flat = _pairs(vs.knn(vs.build_index(emb, 64), emb, 10))
    sharded = vs.build_index(emb, 64, shard=F.col("id") % 5)
    assert _pairs(vs.knn(sharded, emb, 10, scope="global")) == flat
    local = vs.knn(sharded, emb, 10, scope="shard")
    assert local.groupBy("query_idx", "shard_id").count().where("count > 10").count() == 0


def test_pq_recall_and_rerank_free_codes(spark, emb):
    flat = {(q, v) for q, v, *_ in _pairs(vs.knn(vs.build_index(emb, 64), emb, 10))}
    pq = vs.build_index(emb, 64, "ivf_pq", nlist=2, m=16, ks=16, iterations=4)
    code = vs.code_array("code", 16, 16)
    codes = pq.postings.select(F.size(code).alias("m"), F.array_max(code).alias("mx")).collect()
    assert all(r["m"] == 16 and r["mx"] < 16 for r in codes)
    got = {(q, v) for q, v, *_ in _pairs(vs.knn(pq, emb, 10, nprobe=2))}
    assert len(got & flat) / len(flat) > 0.3


def test_tag_filter_is_pushed_before_search(spark, emb):
    idx = vs.build_index(emb, 64, tag_columns=["label"])
    res = vs.knn(idx, emb, 5, where=F.col("label") == 3)
    labels = {r["id"]: r["label"] for r in emb.select("id", "label").collect()}
    assert all(labels[r["vector_idx"]] == 3 for r in res.collect())


def test_save_and_load_round_trip(spark, emb):
    idx = vs.build_index(emb, 64, "ivf_flat", nlist=4, iterations=2, nprobe=2, tag_columns=["label"])
    path = os.path.join(tempfile.mkdtemp(prefix="vecspark-idx-"), "idx")
    vs.save_index(idx, path)
    back = vs.load_index(spark, path)
    assert back.spec == idx.spec and back.options == idx.options and back.tag_columns == ("label",)
    assert _pairs(vs.knn(back, emb, 5)) == _pairs(vs.knn(idx, emb, 5))


def test_sequential_ids_follow_order_column(spark, emb):
    idx = vs.add_vectors(vs.create_index(spark, 64), emb.withColumn("ord", -F.col("id")), id_col=None,
                         order_col="ord")
    idx = vs.add_vectors(idx, emb.where("id < 3").withColumn("ord", F.col("id")), id_col=None, order_col="ord")
    rows = {r["id"]: r["vector"] for r in idx.postings.collect()}
    n = emb.count()
    assert sorted(rows) == list(range(n + 3))
    first = emb.where(f"id = {n - 1}").first()["vector"]
    assert rows[0] == first


def test_wrong_dimension_and_nulls_raise(spark):
    bad = spark.createDataFrame([(1, [1.0, 2.0])], "id long, vector array<float>")
    with pytest.raises(Exception):
        vs.build_index(bad, 3).postings.collect()
    nul = spark.createDataFrame([(1, [1.0, None, 2.0])], "id long, vector array<float>")
    with pytest.raises(Exception):
        vs.build_index(nul, 3).postings.collect()
    with pytest.raises(Exception):
        vs.unpack_vectors(spark.createDataFrame([([1.0, 2.0, 3.0],)], "vectors array<float>"), 2,
                          ids_col=None).collect()


def test_pack_unpack_round_trip(spark, emb):
    packed = vs.pack_vectors(emb, by=["label"], page_size=64)
    assert packed.select(F.max(F.size("ids"))).first()[0] <= 64
    back = vs.unpack_vectors(packed, 64, keep=["label"])
    assert sorted(tuple(r) for r in back.select("id", "label").collect()) == \
        sorted(tuple(r) for r in emb.select("id", "label").collect())


def test_inner_product_ranks_descending(spark, emb):
    idx = vs.build_index(emb, 64, metric="ip")
    rows = vs.knn(idx, emb, 3).where("query_idx = 0").orderBy("ranking").collect()
    assert rows[0]["vector_idx"] == 0
    assert rows[0]["distance"] >= rows[1]["distance"] >= rows[2]["distance"]


def test_pq_rerank_with_raw_vectors(spark, emb):
    flat = {(q, v) for q, v, *_ in _pairs(vs.knn(vs.build_index(emb, 64), emb, 10))}
    pq = vs.build_index(emb, 64, "ivf_pq", nlist=2, m=16, ks=16, iterations=4, refine=True, nprobe=2)
    plain = {(q, v) for q, v, *_ in _pairs(vs.knn(pq, emb, 10))}
    reranked = vs.knn(vs.set_options(pq, rerank=100), emb, 10)
    got = {(q, v) for q, v, *_ in _pairs(reranked)}
    assert len(got & flat) / len(flat) > max(0.9, len(plain & flat) / len(flat))
    with pytest.raises(ValueError):
        vs.knn(vs.set_options(vs.build_index(emb, 64, "ivf_pq", nlist=2, m=16, ks=16, iterations=2), rerank=5),
               emb, 3).collect()


@pytest.mark.parametrize("metric", ["l2", "ip", "l1", "linf"])
def test_distance_column_matches_kernel(spark, emb, metric):
    from vecspark.functions import kernels
    from vecspark.functions.distance import distance
    rows = emb.orderBy("id").collect()
    v = np.array([r["vector"] for r in rows], dtype=np.float64)
    probe = [float(x) for x in rows[0]["vector"]]
    got = emb.select("id", distance(F.col("vector"), F.array(*[F.lit(x) for x in probe]), metric).alias("d")).collect()
    _, vi, d = kernels.search_block(np.array([probe]), v, np.arange(len(v)), metric, k=len(v))
    exact = dict(zip(vi.tolist(), d.tolist()))
    pos = {r["id"]: i for i, r in enumerate(rows)}
    for r in got:
        assert abs(exact[pos[r["id"]]] - r["d"]) < 1e-12


def test_keys_are_stored_and_dropped_on_change(spark, emb):
    idx = vs.with_keys(vs.build_index(emb, 64, shard=F.col("id") % 3))
    stored = {r["shard_id"]: r["index_key"] for r in vs.index_keys(idx).collect()}
    assert len(stored) == 3
    from vecspark.plans.index import _compute_keys
    assert stored == {r["shard_id"]: r["index_key"] for r in _compute_keys(idx).collect()}
    changed = vs.set_options(idx, nprobe=2)
    assert "keys" not in changed.extra
    assert {r["index_key"] for r in vs.index_keys(changed).collect()}.isdisjoint(stored.values())
    got = vs.knn(idx, emb, 3, index_key=stored[1]).collect()
    assert {r["vector_idx"] % 3 for r in got} == {1}


def test_training_on_fewer_vectors_is_the_callers_table(spark, emb):
    idx = vs.create_index(spark, 64, "ivf_flat", nlist=4, iterations=2)
    idx = vs.add_vectors(vs.train_index(idx, emb.where("id % 2 = 0")), emb)
    assert idx.postings.count() == emb.count()


def test_empty_and_untrained_indexes(spark, emb):
    empty = vs.create_index(spark, 64)
    rows = vs.search(empty, emb.where("id < 3"), 5).collect()
    assert len(rows) == 3 and all(r["vector_idxs"] == [] and r["distances"] == [] for r in rows)
    assert vs.knn(empty, emb.where("id < 3"), 5).count() == 0
    with pytest.raises(ValueError):
        vs.knn(vs.create_index(spark, 64, "ivf_flat", nlist=4), emb, 5)
    with pytest.raises(ValueError):
        vs.add_vectors(vs.create_index(spark, 64, "ivf_flat", nlist=4), emb)


def test_fewer_stored_vectors_than_k(spark, emb):
    idx = vs.build_index(emb.where("id < 3"), 64)
    rows = vs.search(idx, emb.where("id < 2"), 10).collect()
    assert all(len(r["vector_idxs"]) == 3 for r in rows)


@pytest.fixture(scope="module")
def sharded_ivf(emb):
    return vs.build_index(emb, 64, "ivf_flat", nlist=3, iterations=2, nprobe=2, shard=F.col("id") % 3)


@pytest.mark.parametrize("scope", ["shard", "global"])
def test_strategies_agree_on_sharded_ivf(spark, emb, sharded_ivf, scope):
    spark.conf.set("vecspark.tile.bytes", str(30 * (8 * 64 + 16)))
    try:
        results = []
        for strategy in ("broadcast_items", "broadcast_queries", "tiled"):
            rows = vs.knn(sharded_ivf, emb, 4, scope=scope, strategy=strategy).collect()
            results.append(sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows))
    finally:
        spark.conf.unset("vecspark.tile.bytes")
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == emb.count() * 4 * (3 if scope == "shard" else 1)


def test_strategies_agree_on_ivf_radius(spark, emb, sharded_ivf):
    spark.conf.set("vecspark.tile.bytes", str(30 * (8 * 64 + 16)))
    try:
        got = [sorted((r["query_idx"], r["vector_idx"], round(r["distance"], 6)) for r in
                      vs.range_search(sharded_ivf, emb, 1.3, strategy=s).collect())
               for s in ("broadcast_items", "broadcast_queries", "tiled")]
    finally:
        spark.conf.unset("vecspark.tile.bytes")
    assert got[0] == got[1] == got[2] and len(got[0]) >= emb.count()


def test_pq_encode_paths_agree(spark, emb):
    from vecspark.operators import kmeans as km
    from vecspark.operators import pq
    idx = vs.build_index(emb, 64, "ivf_pq", nlist=2, m=8, ks=16, iterations=2)
    rows = km.assign_lists(emb.select(F.lit(0).alias("shard_id"), "id", F.col("vector").alias("_v"), "vector"),
                           idx.centroids, dim=64, metric="l2", group_keys=["shard_id"], id_col="id").drop("_v")
    args = dict(m=8, dsub=8, ks=16, groups=1, nlist=2)
    in_place = {r["id"]: list(r["code"]) for r in pq.encode(rows, idx.centroids, idx.codebooks, **args).collect()}
    spark.conf.set("vecspark.broadcast.maxBytes", "1")
    try:
        exploded = {r["id"]: list(r["code"]) for r in pq.encode(rows, idx.centroids, idx.codebooks, **args).collect()}
    finally:
        spark.conf.unset("vecspark.broadcast.maxBytes")
    assert in_place == exploded
    assert in_place == {r["id"]: list(r["code"]) for r in idx.postings.collect()}


def test_every_fallback_path_gives_the_same_index_and_results(spark, emb):
    """A 1-byte broadcast budget forces tiled k-means (checkpointed centroids), tiled assignment,
    exploded PQ encoding, join-based decoding and tiled search; all must agree with the default."""
    def run():
        idx = vs.build_index(emb, 64, "ivf_pq", nlist=3, m=8, ks=8, iterations=2, nprobe=2)
        cents = sorted((r["list_id"], tuple(round(x, 9) for x in r["centroid"])) for r in idx.centroids.collect())
        codes = sorted((r["id"], r["list_id"], tuple(r["code"])) for r in idx.postings.collect())
        hits = _pairs(vs.knn(idx, emb.where("id < 40"), 5))
        return cents, codes, hits
    default = run()
    spark.conf.set("vecspark.broadcast.maxBytes", "1")
    try:
        forced = run()
    finally:
        spark.conf.unset("vecspark.broadcast.maxBytes")
    assert default[0] == forced[0]
    assert default[1] == forced[1]
    assert default[2] == forced[2]


@pytest.mark.parametrize("metric", ["l2", "ip", "l1", "linf"])
def test_distance_sql_matches_column(spark, emb, metric):
    from vecspark.functions.distance import distance, distance_sql
    pairs = emb.where("id < 20").select("id", "vector", F.reverse("vector").alias("other"))
    got = pairs.select("id", distance("vector", "other", metric).alias("c"),
                       F.expr(distance_sql("vector", "other", metric)).alias("s")).collect()
    assert all(r["c"] == r["s"] for r in got)


def test_positions_are_dense_and_ordered_after_a_shuffle(spark, emb):
    """Positions come from one checkpointed tagging, so a shuffled input cannot make them inconsistent."""
    from vecspark.operators.ranking import positions
    shuffled = (emb.withColumn("g", (F.col("id") % 7).cast("int"))
                .withColumn("sub", F.explode(F.sequence(F.lit(0), F.lit(3))))
                .repartition(5, "label"))
    pos = positions(shuffled.select("g", "sub", "id"), ["id"], ["g", "sub"]).collect()
    by_group = {}
    for r in pos:
        by_group.setdefault((r["g"], r["sub"]), []).append((r["_pos"], r["id"]))
    for rows in by_group.values():
        rows.sort()
        assert [p for p, _ in rows] == list(range(len(rows)))
        assert [i for _, i in rows] == sorted(i for _, i in rows)
    assert len(pos) == emb.count() * 4


def test_large_k_warns_about_the_partial_top_k(spark, emb):
    import warnings as w
    idx = vs.build_index(emb, 64)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        with w.catch_warnings(record=True) as caught:
            w.simplefilter("always")
            rows = vs.knn(idx, emb.where("id < 3"), 6, strategy="broadcast_queries").collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert any("windowGroupLimitThreshold" in str(x.message) for x in caught)
    assert len(rows) == 18


def test_ivfpq_save_load_round_trip_with_rerank_and_keys(spark, emb):
    idx = vs.with_keys(vs.build_index(emb, 64, "ivf_pq", nlist=2, m=8, ks=16, iterations=2, refine=True,
                                      nprobe=2, rerank=30, tag_columns=["label"], shard=F.col("id") % 2))
    path = os.path.join(tempfile.mkdtemp(prefix="vecspark-pq-"), "idx")
    vs.save_index(idx, path)
    back = vs.load_index(spark, path)
    assert back.spec == idx.spec and back.options == idx.options and back.tag_columns == ("label",)
    assert sorted(tuple(r) for r in vs.index_keys(back).collect()) == \
        sorted(tuple(r) for r in vs.index_keys(idx).collect())
    key = vs.index_keys(back).where("shard_id = 1").first()["index_key"]
    assert _pairs(vs.knn(back, emb, 5, index_key=key)) == _pairs(vs.knn(idx, emb, 5, index_key=key))
    assert _pairs(vs.knn(back, emb, 5, where=F.col("label") < 5)) == _pairs(vs.knn(idx, emb, 5, where=F.col("label") < 5))
