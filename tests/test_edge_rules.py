"""Rows that do not behave: non-finite vectors, repeated ids, ties, NULLs, many lists, radii that hit everything."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import vecspark as vs
from vecspark.functions import kernels
from vecspark.functions.distance import distance, distance_sql
from vecspark.operators import nearest as nn
from vecspark.operators import pq
from vecspark.operators.ranking import with_positions


@pytest.fixture(scope="module")
def emb(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in v], int(i % 10)) for i, v in enumerate(rng.normal(size=(500, 8)).astype(np.float32))]
    return spark.createDataFrame(rows, "id bigint, vector array<float>, label int").cache()


@pytest.mark.parametrize("metric", ["l2", "ip", "l1", "linf"])
@pytest.mark.parametrize("mode", ["k", "radius"])
@pytest.mark.parametrize("bad", [np.nan, np.inf, -np.inf])
def test_kernel_sets_nonfinite_rows_aside(metric, mode, bad):
    rng = np.random.default_rng(1)
    q, v = rng.normal(size=(6, 4)), rng.normal(size=(40, 4))
    options = {"k": 5} if mode == "k" else {"radius": 1.0}
    qi, vi, d = kernels.search_block(q, v, np.arange(40), metric, **options)
    q2, v2 = np.insert(q, 2, 0.0, axis=0), np.insert(v, 7, 0.0, axis=0)
    q2[2, 1] = v2[7, 0] = bad
    a, b, e = kernels.search_block(q2, v2, np.arange(41), metric, **options)
    assert (a == qi + (qi >= 2)).all() and (b == vi + (vi >= 7)).all() and (e == d).all()


def test_pairs_are_recomputed_in_bounded_memory():
    rng = np.random.default_rng(2)
    q, v = rng.normal(size=(20_000, 64)), rng.normal(size=(90, 64))
    tracemalloc.start()
    kernels.search_block(q, v, np.arange(90), "l2", k=100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6


@pytest.mark.parametrize("strategy", ["broadcast_items", "broadcast_queries", "tiled"])
def test_query_ids_are_labels(spark, emb, strategy):
    idx = vs.build_index(emb, 8)
    want = {r["query_idx"]: [] for r in emb.select(F.col("id").alias("query_idx")).where("id < 20").collect()}
    for r in vs.knn(idx, emb.where("id < 20"), 4, strategy=strategy).orderBy("query_idx", "ranking").collect():
        want[r["query_idx"]].append(r["vector_idx"])
    rows = vs.knn(idx, emb.where("id < 20").withColumn("id", F.lit(7)), 4, strategy=strategy).collect()
    assert {r["query_idx"] for r in rows} == {7}
    assert sorted(r["vector_idx"] for r in rows) == sorted(x for v in want.values() for x in v)
    assert sorted(r["ranking"] for r in rows) == sorted(list(range(1, 5)) * 20)


def test_positions_with_ties_and_nulls_lose_no_row(spark, emb):
    rows = emb.withColumn("key", F.when(F.col("label") != 3, F.col("label"))).withColumn("g", F.col("id") % 2)
    got = with_positions(rows, ["key"], ["g"]).collect()
    assert len(got) == 500
    for g in (0, 1):
        own = sorted((r["_pos"], r["key"]) for r in got if r["g"] == g)
        assert [p for p, _ in own] == list(range(250))
        assert [k for _, k in own] == sorted((k for _, k in own), key=lambda k: (k is not None, k))


def test_add_without_ids_over_a_tied_order_column(spark, emb):
    idx = vs.add_vectors(vs.create_index(spark, 8), emb, id_col=None, order_col="label")
    assert sorted(r["id"] for r in idx.postings.collect()) == list(range(500))


@pytest.mark.parametrize("kind", ["flat", "ivf_flat", "ivf_pq"])
def test_build_without_ids_of_every_kind(spark, emb, kind):
    options = {"flat": {}, "ivf_flat": {"nlist": 4}, "ivf_pq": {"nlist": 4, "m": 4, "ks": 8}}[kind]
    idx = vs.build_index(emb, 8, kind, id_col=None, order_col="label", iterations=2, **options)
    assert sorted(r["id"] for r in idx.postings.collect()) == list(range(500))


def test_training_and_ivf_add_refuse_nonfinite_vectors(spark, emb):
    bad = emb.withColumn("vector", F.when(F.col("id") == 5, F.transform("vector", lambda x: F.lit(float("nan")).cast("float")))
                         .otherwise(F.col("vector")))
    with pytest.raises(Exception, match="NaN or infinite"):
        vs.build_index(bad, 8, "ivf_flat", nlist=4, iterations=1).postings.count()
    good = vs.build_index(emb, 8, "ivf_flat", nlist=4, iterations=1)
    with pytest.raises(Exception, match="NaN or infinite"):
        vs.add_vectors(good, bad).postings.write.format("noop").mode("overwrite").save()


def test_more_than_4096_probed_groups_still_filter_the_scan(spark):
    scan = spark.range(0, 20_000).select(F.col("id").cast("int").alias("list_id"))
    wanted = np.arange(0, 10_000, 2)
    out = nn.scan_filter(scan, ["list_id"], [wanted])
    assert {r[0] for r in out.collect()} == set(wanted.tolist())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "9998" in plan


def test_broadcast_budget_counts_the_hits_a_task_holds(spark, emb):
    qs = emb.select(F.col("id").alias("_qid"), F.col("vector").alias("_qv"))
    items = emb.select(F.col("id").alias("_id"), F.col("vector").alias("_v"))
    budget = nn.side_bytes(500, 8) + 100
    assert nn.choose_strategy(qs, items, 8, budget, hits=0)[0] == "broadcast_queries"
    assert nn.choose_strategy(qs, items, 8, budget, hits=1000)[0] == "broadcast_items"
    assert nn.choose_strategy(qs, items, 8, 1, hits=1000)[0] == "tiled"


@pytest.mark.parametrize("strategy", ["broadcast_items", "broadcast_queries", "tiled"])
def test_a_radius_that_hits_every_pair(spark, emb, strategy):
    idx = vs.build_index(emb, 8)
    assert vs.range_search(idx, emb, 1e9, strategy=strategy).count() == 250_000


def test_keys_identify_the_contents(spark):
    def key(rows, **options):
        df = spark.createDataFrame(rows, "id bigint, vector array<float>, tag string")
        return vs.index_keys(vs.build_index(df, 2, tag_columns=["tag"], **options)).first()["index_key"]

    base = key([(1, [1.0, 0.0], "a")] * 2)
    assert base == key([(1, [1.0, 0.0], "a")] * 2)
    assert len({base, key([(2, [2.0, 0.0], "a")] * 2), key([(1, [1.0, 0.0], "b")] * 2), key([(1, [1.0, 0.0], "a")] * 4)}) == 4


def test_key_covers_codebooks(spark, emb):
    idx = vs.build_index(emb, 8, "ivf_pq", nlist=2, m=2, ks=4, iterations=1)
    other = idx.replace(codebooks=idx.codebooks.withColumn("centroid", F.transform("centroid", lambda x: x + 1)))
    assert vs.index_keys(idx).first()["index_key"] != vs.index_keys(other).first()["index_key"]


def test_string_shards_with_null_survive_save_and_load(spark, emb, tmp_path):
    shard = F.when(F.col("label") != 9, F.concat(F.lit("s"), (F.col("label") % 3).cast("string")))
    idx = vs.build_index(emb, 8, "ivf_flat", nlist=2, iterations=1, nprobe=2, shard=shard)
    vs.save_index(idx, str(tmp_path / "idx"))
    idx = vs.load_index(spark, str(tmp_path / "idx"))
    labels = {r["shard_id"]: r["shard"] for r in vs.shard_labels(idx).collect()}
    assert sorted(labels.values(), key=str) == [None, "s0", "s1", "s2"]
    got = vs.knn(idx, emb.where("id < 3"), 5, scope="shard")
    assert got.groupBy("shard_id").count().count() == 4
    more = vs.add_vectors(idx, emb.where("id < 4").withColumn("id", F.col("id") + 1000), shard=shard)
    assert more.postings.count() == 504
    with pytest.raises(ValueError, match="sharded"):
        vs.add_vectors(idx, emb)


def test_small_rules(spark, emb):
    lists = spark.createDataFrame([([None, 5], [1.0, 2.0])], "idxs array<bigint>, distances array<double>")
    with pytest.raises(Exception, match="NULL"):
        vs.topk_merge(lists, 1).collect()
    pair = spark.createDataFrame([([1.0, 2.0], [0.0])], "a array<double>, b array<double>")
    row = pair.select(distance("a", "b", "linf"), F.expr(distance_sql("a", "b", "linf")), distance("a", "b", "l2")).first()
    assert list(row) == [None, None, None]
    ivf = vs.build_index(emb, 8, "ivf_flat", nlist=4, iterations=1)
    with pytest.raises(ValueError):
        vs.knn(ivf, emb, 3, nprobe=0)
    words = emb.where("id < 30").withColumn("name", F.format_string("n%03d", 99 - F.col("id")))
    packed = vs.array_1d_extend(words, order_col="name", page_size=10)
    first = packed.orderBy("page").first()["vectors"]
    assert packed.count() == 3 and first[:8] == emb.where("id = 29").first()["vector"]


def test_rerank_with_repeated_stored_ids_and_radius(spark, emb):
    twice = emb.unionByName(emb.where("id = 0"))
    idx = vs.build_index(twice, 8, "ivf_pq", nlist=2, m=4, ks=16, iterations=1, refine=True, nprobe=2, rerank=20)
    rows = [r["vector_idx"] for r in vs.knn(idx, emb.where("id = 0"), 5).orderBy("ranking").collect()]
    assert rows[0] == 0 and len(set(rows)) == 5
    with pytest.raises(ValueError, match="rerank"):
        vs.range_search(idx, emb, 1.0)


def test_pq_encode_does_not_slow_down_with_the_number_of_lists():
    import time

    import pyarrow as pa

    rng, m, ks, dsub, nlist = np.random.default_rng(0), 8, 256, 8, 65536
    cents = pa.table({"shard_id": np.zeros(nlist, np.int32), "list_id": np.arange(nlist, dtype=np.int32),
                      "centroid": pa.FixedSizeListArray.from_arrays(pa.array(rng.normal(size=nlist * 64)), 64).cast(pa.list_(pa.float64()))})
    books = pa.table({"shard_id": np.zeros(m * ks, np.int32), "sub": np.repeat(np.arange(m, dtype=np.int32), ks),
                      "code": np.tile(np.arange(ks, dtype=np.int32), m),
                      "centroid": pa.FixedSizeListArray.from_arrays(pa.array(rng.normal(size=m * ks * dsub)), dsub).cast(pa.list_(pa.float64()))})
    tables = pq._Tables(cents, books, 64, m, dsub, ks)
    start = time.process_time()
    res = rng.normal(size=(10_000, 64)) - tables.centroids_of(np.zeros(10_000), rng.integers(0, nlist, 10_000))
    for j in range(m):
        kernels.search_block(res[:, j * dsub:(j + 1) * dsub], tables.books[0, j], np.arange(ks), "l2", k=1)
    assert time.process_time() - start < 5
