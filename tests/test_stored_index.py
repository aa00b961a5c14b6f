import os

import pytest
from pyspark.sql import functions as F

import vecspark as vs
from vecspark.operators import nearest as nn
from vecspark.plans import index as ix
from vecspark.plans import probing
from vecspark.sources.tables import embeddings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def emb(spark):
    return embeddings(spark, SF).persist()


def _pairs(df):
    return sorted((r["query_idx"], r["vector_idx"], round(r["distance"], 9)) for r in df.collect())


def _trained(spark, emb):
    return vs.train_index(vs.create_index(spark, 64, "ivf_flat", nlist=8, iterations=2), emb)


def test_appends_versions_and_compaction(spark, emb, tmp_path, monkeypatch):
    path, idx = str(tmp_path / "index"), _trained(spark, emb)
    whole = vs.add_vectors(idx, emb, tag_columns=["label"])
    vs.save_index(vs.add_vectors(idx, emb.where("id < 200"), tag_columns=["label"]), path)
    assert vs.append_to_index(spark, path, emb.where("id >= 200 and id < 300"), tag_columns=["label"]) == 1

    # An append that fails after its segment is written leaves the version before it as it was.
    commit = ix._commit
    monkeypatch.setattr(ix, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        vs.append_to_index(spark, path, emb.where("id >= 300"), tag_columns=["label"])
    monkeypatch.setattr(ix, "_commit", commit)
    assert vs.load_index(spark, path).postings.count() == 300
    assert vs.append_to_index(spark, path, emb.where("id >= 300"), tag_columns=["label"]) == 2

    q = emb.where("id < 60")
    want = _pairs(vs.knn(whole, q, 5, nprobe=3))
    assert _pairs(vs.knn(vs.load_index(spark, path), q, 5, nprobe=3)) == want
    assert vs.load_index(spark, path, version=0).postings.count() == 200
    keys = [r["index_key"] for r in vs.index_keys(vs.load_index(spark, path)).collect()]
    assert keys == [r["index_key"] for r in vs.index_keys(whole).collect()]
    assert vs.compact_index(spark, path) == 3 and vs.compact_index(spark, path) == 3
    again = vs.load_index(spark, path)
    assert _pairs(vs.knn(again, q, 5, nprobe=3)) == want and [r["index_key"] for r in vs.index_keys(again).collect()] == keys
    with pytest.raises(ValueError, match="version"):
        vs.load_index(spark, path, version=9)
    vs.save_index(whole, path, mode="overwrite")
    assert vs.load_index(spark, path).postings.count() == emb.count()


def test_appends_of_tags_string_shards_and_rows_without_ids(spark, emb, tmp_path):
    path, shard = str(tmp_path / "index"), F.concat(F.lit("t"), F.col("label").cast("string"))
    vs.save_index(vs.build_index(emb.where("label < 3"), 64, id_col=None, order_col="id", shard=shard), path)
    vs.append_to_index(spark, path, emb.where("label between 2 and 5"), id_col=None, order_col="id", shard=shard, tag_columns=["label"])
    idx = vs.load_index(spark, path)
    rows = idx.postings.join(vs.shard_labels(idx), "shard_id").groupBy("shard").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.max("id").alias("last"),
        F.count("label").alias("tagged")).collect()
    counts = {r["label"]: r["count"] for r in emb.groupBy("label").count().collect()}
    assert len(rows) == 6
    for r in rows:
        label = int(r["shard"][1:])
        n = counts[label] * (2 if label == 2 else 1)
        assert (r["n"], r["ids"], r["last"], r["tagged"]) == (n, n, n - 1, counts[label] if label >= 2 else 0)


def test_a_probe_reads_the_row_groups_of_its_lists(spark, emb, tmp_path, monkeypatch):
    monkeypatch.setattr(ix, "ROW_GROUP_BYTES", 1 << 14)
    many = emb.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(19)))).select((F.col("id") * 20 + F.col("c")).alias("id"), "vector")
    path = str(tmp_path / "index")
    vs.save_index(vs.build_index(many, 64, "ivf_flat", nlist=16, iterations=1), path)
    post = vs.load_index(spark, path).postings
    scan = nn.scan_filter(post, ["shard_id", "list_id"], [[0], [5]], 16)
    scan.count()
    plan = scan._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [" in plan.toString() or "list_id" in plan.toString()
    got, size = scan.select("list_id").distinct().collect(), post.where("list_id = 5").count()
    assert [r["list_id"] for r in got] == [5] and size < post.count() / 4
    assert len([f for f in os.listdir(f"{path}/postings/segment=s0/shard_id=0") if f.endswith(".parquet")]) >= 1


def test_exact_radius_search_skips_lists(spark):
    rows = [(i, [float(10 * (i % 6)) + ((i * 37 + j * 11) % 17) / 50 for j in range(4)]) for i in range(240)]
    df = spark.createDataFrame(rows, "id bigint, vector array<float>")
    for metric in ("l2", "l1", "linf"):
        idx = vs.build_index(df, 4, "ivf_flat", metric, nlist=6, iterations=3)
        for radius in (0.2, 5.0, 500.0):
            assert _pairs(vs.range_search(idx, df, radius, exact=True)) == _pairs(vs.range_search(vs.build_index(df, 4, metric=metric), df, radius))
    from vecspark.plans.search import prepare_queries
    probed = probing.shell_probe(vs.build_index(df, 4, "ivf_flat", nlist=6, iterations=3), prepare_queries(df, 4), idx.centroids, 0.2).count()
    assert probed <= 240 * 2  # of 240 * 6
    with pytest.raises(ValueError, match="exact"):
        vs.range_search(vs.build_index(df, 4), df, 1.0, exact=True)


def test_filled_probes_find_k_where_k_exist(spark, emb):
    rare = emb.withColumn("tag", F.when(F.col("id") % 71 == 0, 1).otherwise(0))
    idx = vs.build_index(rare, 64, "ivf_flat", nlist=8, iterations=2, tag_columns=["tag"])
    want = rare.where("tag = 1").count()
    plain = vs.knn(idx, emb, 10, where=F.col("tag") == 1).groupBy("query_idx").count()
    full = vs.knn(idx, emb, 10, where=F.col("tag") == 1, fill=True)
    assert full.groupBy("query_idx").count().where(F.col("count") != min(10, want)).count() == 0
    assert plain.where(F.col("count") < min(10, want)).count() > 0
    spark.conf.set("vecspark.broadcast.maxBytes", "1")
    try:
        beyond = _pairs(vs.knn(idx, emb.where("id < 30"), 10, where=F.col("tag") == 1, fill=True))
    finally:
        spark.conf.unset("vecspark.broadcast.maxBytes")
    assert beyond == [p for p in _pairs(full) if p[0] < 30]


@pytest.mark.parametrize("metric", ["l2", "ip"])
def test_waves_give_the_same_and_send_less(spark, emb, metric):
    idx = vs.build_index(emb.repartition(8), 64, metric=metric, shard=F.col("id") % 4)
    assert _pairs(vs.knn(idx, emb, 5, waves=True)) == _pairs(vs.knn(idx, emb, 5))
    from vecspark.plans import search as sr
    sent, rank = [], nn.rank_final
    try:
        sr.nn.rank_final = lambda df, *a: (sent.append(df.count()), rank(df, *a))[1]
        vs.knn(idx, emb, 5, waves=True)
        vs.knn(idx, emb, 5)
    finally:
        sr.nn.rank_final = rank
    # Beyond the first wave's result (5 rows a query), half of what the tasks send otherwise.
    assert sent[-2] - 5 * emb.count() < sent[-1] / 2


def test_each_query_meets_the_index_of_its_key(spark, emb):
    idx = vs.with_keys(vs.build_index(emb, 64, "ivf_flat", nlist=2, iterations=2, shard=F.col("id") % 3, nprobe=2))
    asked = emb.withColumn("shard_id", (F.col("id") % 4).cast("int")).join(vs.index_keys(idx), "shard_id", "left")
    hits = vs.knn(idx, asked, 4, key_col="index_key").collect()
    assert {r["query_idx"] for r in hits} == {r["id"] for r in asked.where("shard_id < 3").collect()}
    assert all(r["vector_idx"] % 3 == r["query_idx"] % 4 for r in hits)
    near = vs.range_search(idx, asked, 1.0, key_col="index_key", nprobe=2).collect()
    assert near and all(r["vector_idx"] % 3 == r["query_idx"] % 4 for r in near)
