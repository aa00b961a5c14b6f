"""Centroid sums added as a tree over the tasks, and broadcasts whose sides are measured."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import vecspark as vs
from vecspark.operators import kmeans as km
from vecspark.operators import nearest as nn
from vecspark.operators.ranking import with_positions


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), int(i % 3), rng.normal(size=4).tolist()) for i in range(600)]
    return spark.createDataFrame(rows, "_id long, shard_id int, _v array<double>").repartition(23, "_id")


def _centroids(df):
    return {(r["shard_id"], r["list_id"]): r["centroid"] for r in df.collect()}


def test_tree_gives_the_same_centroids(spark, train, monkeypatch):
    flat = _centroids(km.kmeans(train, dim=4, nlist=5, iterations=4, group_keys=["shard_id"]))
    monkeypatch.setattr(km, "FAN_IN", 2)
    tree = _centroids(km.kmeans(train, dim=4, nlist=5, iterations=4, group_keys=["shard_id"]))
    assert flat.keys() == tree.keys() and len(flat) == 15
    for key, c in flat.items():
        assert np.allclose(c, tree[key], rtol=1e-12, atol=1e-12)


def test_a_round_adds_at_most_the_fan_in(spark, train, monkeypatch):
    monkeypatch.setattr(km, "FAN_IN", 4)
    sums = train.select("shard_id", F.lit(0).alias("list_id"), F.spark_partition_id().alias("_task"),
                        F.lit(1).cast("long").alias("_cnt"), F.col("_v").alias("_sum")).groupBy("shard_id", "list_id", "_task").agg(
        F.sum("_cnt").alias("_cnt"), F.array(*[F.sum(F.col("_sum")[i]) for i in range(4)]).alias("_sum")).checkpoint(eager=True)
    want = {r[0]: (r[1], r[2]) for r in train.groupBy("shard_id").agg(F.count("*"), F.sum(F.col("_v")[2])).collect()}
    rows = [sums.count()]
    while rows[-1] > 3:
        widest = sums.groupBy("shard_id", F.floor(F.col("_task") / 4)).count().agg(F.max("count")).first()[0]
        assert widest <= 4
        sums = km.add_sums(sums, ["shard_id", "list_id"], dim=4)
        rows.append(sums.count())
    assert len(rows) >= 3  # 23 tasks, then 6 nodes, then 2, then 1
    for r in sums.collect():
        assert r["_cnt"] == want[r["shard_id"]][0] and r["_sum"][2] == pytest.approx(want[r["shard_id"]][1])


def test_last_round_leaves_one_row_a_list(spark, train):
    """Also where there are more tasks than were counted on."""
    cents = km.initial_centroids(train, nlist=2)
    partials = km.partial_sums(train, cents, dim=4, metric="l2")
    one = km.combine_sums(partials, cents, dim=4, tasks=1)
    assert one.count() == 2 == one.select("list_id").distinct().count()


def test_empty_lists_keep_their_centroid(spark):
    train = spark.createDataFrame([(i, [float(i // 3)]) for i in range(6)], "_id long, _v array<double>")
    got = km.kmeans(train, dim=1, nlist=4, iterations=2).orderBy("list_id").collect()
    assert [r["centroid"][0] for r in got][0] == 0.0 and len(got) == 4


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_positions_with_a_side_beyond_the_budget(spark):
    df = spark.range(400).select((F.col("id") % 40).alias("g"), (F.col("id") * 7919 % 400).alias("o"))
    small = with_positions(df, ["o"], ["g"])
    budget = spark.conf.get("vecspark.broadcast.maxBytes", str(nn.DEFAULT_BROADCAST_BYTES))
    spark.conf.set("vecspark.broadcast.maxBytes", "1")
    try:
        large = with_positions(df, ["o"], ["g"])
        assert "broadcast" in _plan(small) and "strategy=broadcast" not in _plan(large)
        assert {tuple(r) for r in small.collect()} == {tuple(r) for r in large.collect()}
    finally:
        spark.conf.set("vecspark.broadcast.maxBytes", budget)


def test_shard_keys_beyond_the_budget(spark):
    """Long string keys are measured with their length; beyond the budget the key table is joined."""
    df = spark.range(60).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("k" * 500), (F.col("id") % 7).cast("string"))).alias("t"),
                                F.array(F.col("id").cast("float")).alias("vector"))
    within = vs.build_index(df, 1, shard=F.col("t")).postings
    want = {(r["id"], r["shard_id"]) for r in within.collect()}
    spark.conf.set("vecspark.broadcast.maxBytes", "2000")
    try:
        index = vs.build_index(df, 1, shard=F.col("t"))
        # What is left is the side of the row counts, one row a partition.
        assert _plan(within).count("strategy=broadcast") == 2 and _plan(index.postings).count("strategy=broadcast") == 1
        assert {(r["id"], r["shard_id"]) for r in index.postings.collect()} == want and len(want) == 60
    finally:
        spark.conf.unset("vecspark.broadcast.maxBytes")
