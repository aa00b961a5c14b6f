"""Which lists a query probes, beyond a fixed number of nearest ones.

``filled_probe``  as many lists, nearest first, as hold k vectors that pass a filter.
``shell_probe``   every list that can hold a vector within the radius.

Both look at all lists of a shard for each query, in tasks that hold the
centroids and one number or two a list (size-checked and broadcast); they
emit one row per list to probe, with the query's vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions import kernels
from vecspark.model import VectorIndex
from vecspark.operators import nearest as nn
from vecspark.session import ensure_importable

_CELLS = 1 << 22  # (query, list) distances held at a time


def lists_fit(index: VectorIndex, groups: int) -> bool:
    return nn.side_bytes(groups * index.spec.nlist, index.dim) <= nn.broadcast_budget(index.spark)


def _chosen(index: VectorIndex, qs: DataFrame, lists: DataFrame, facts: list[str], pick) -> DataFrame:
    """``shard_id, list_id, _qid, _qlab, _qv`` of the lists that ``pick(order, distances, facts)`` marks.

    ``lists`` has ``shard_id, list_id, centroid`` and the ``facts``; ``pick`` gets, by
    query, the lists' positions nearest first, their distances and the facts.
    """
    spark, spec = index.spark, index.spec
    ensure_importable(spark)
    tbl = lists.select("shard_id", "list_id", "centroid", *facts).toArrow()
    shard = tbl.column("shard_id").to_numpy().astype(np.int64)
    side = {}
    for (s,), rows in kernels.group_rows([shard]):
        rows = rows[np.argsort(tbl.column("list_id").to_numpy()[rows], kind="stable")]
        side[s] = (tbl.column("list_id").to_numpy()[rows].astype(np.int64),
                   np.ascontiguousarray(kernels.list_matrix(tbl.column("centroid"), spec.dim)[rows]),
                   [tbl.column(f).to_numpy(zero_copy_only=False)[rows] for f in facts])
    bc = spark.sparkContext.broadcast(side)
    schema = T.StructType([T.StructField("shard_id", T.IntegerType()), T.StructField("list_id", T.IntegerType()),
                           *[qs.schema[c] for c in ("_qid", "_qlab", "_qv")]])

    def run(batches):
        for rb in batches:
            q = kernels.list_matrix(rb.column("_qv"), spec.dim)
            for s, (ids, cents, known) in bc.value.items():
                prep, step = kernels.prepare_items(cents, spec.metric), max(1, _CELLS // len(ids))
                for at in range(0, len(q), step):
                    qi, vi, d = kernels.search_block(q[at:at + step], cents, ids, spec.metric, k=len(ids), prep=prep)
                    if not len(qi):
                        continue
                    rows, order = qi.reshape(-1, len(ids))[:, 0] + at, vi.reshape(-1, len(ids))
                    a, b = np.nonzero(pick(order, d.reshape(order.shape), known))
                    own = pa.array(rows[a])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(a), s, np.int32)), pa.array(ids[order[a, b]].astype(np.int32)),
                         *[rb.column(c).take(own) for c in ("_qid", "_qlab", "_qv")]], names=schema.names)

    return qs.select("_qid", "_qlab", "_qv").mapInArrow(run, schema)


def filled_probe(index: VectorIndex, qs: DataFrame, cents: DataFrame, post: DataFrame, k: int, nprobe: int, groups: int) -> DataFrame:
    """Per query and shard: the ``nprobe`` nearest lists, and on until they hold k rows of ``post`` (filtered postings).

    Lists without such a row are passed over.
    """
    counts = post.groupBy("shard_id", "list_id").agg(F.count(F.lit(1)).alias("n"))
    lists = cents.join(counts, ["shard_id", "list_id"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    if lists_fit(index, groups):
        def pick(order, _, facts):
            held = facts[0][order]
            before = np.cumsum(held, axis=1) - held
            return (held > 0) & ((before < k) | (np.arange(order.shape[1])[None] < nprobe))

        return _chosen(index, qs, lists, ["n"], pick)
    ranked = nn.nearest(qs, cents.select("shard_id", F.col("list_id").cast("long").alias("_id"), F.col("centroid").alias("_v")),
                        dim=index.dim, metric=index.metric, k=index.spec.nlist, per_keys=["shard_id"], strategy="tiled")
    by = Window.partitionBy("_qid", "shard_id").orderBy("_rank")
    ranked = (ranked.withColumn("list_id", F.col("_id").cast("int")).join(lists.select("shard_id", "list_id", "n"), ["shard_id", "list_id"])
              .withColumn("before", F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    probe = ranked.where((F.col("n") > 0) & ((F.col("before") < k) | (F.col("_rank") <= nprobe)))
    return probe.select("shard_id", "list_id", "_qid").join(qs.select("_qid", "_qlab", "_qv"), "_qid").select(
        "shard_id", "list_id", "_qid", "_qlab", "_qv")


def list_shells(index: VectorIndex, cents: DataFrame) -> DataFrame:
    """``shard_id, list_id, near, far``: least and largest distance (square roots for l2) of a list's vectors from its centroid."""
    spec = index.spec
    tbl = cents.select("shard_id", "list_id", "centroid").toArrow()
    key = (tbl.column("shard_id").to_numpy().astype(np.int64) << 32) | tbl.column("list_id").to_numpy()
    order = np.argsort(key)
    bc = index.spark.sparkContext.broadcast((key[order], kernels.list_matrix(tbl.column("centroid"), spec.dim)[order]))

    def run(batches):
        keys, mat = bc.value
        near, far = np.full(len(keys), np.inf), np.full(len(keys), -np.inf)
        for rb in batches:
            if rb.num_rows:
                own = (rb.column("shard_id").to_numpy().astype(np.int64) << 32) | rb.column("list_id").to_numpy()
                at = np.searchsorted(keys, own)
                d = kernels.pair_exact(kernels.list_matrix(rb.column("vector"), spec.dim), mat[at], spec.metric)
                d = np.sqrt(d) if spec.metric == "l2" else d
                np.minimum.at(near, at, d)
                np.maximum.at(far, at, d)
        seen = np.flatnonzero(far >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array((keys[seen] >> 32).astype(np.int32)), pa.array((keys[seen] & 0xFFFFFFFF).astype(np.int32)),
             pa.array(near[seen]), pa.array(far[seen])], names=["shard_id", "list_id", "near", "far"])

    parts = index.postings.select("shard_id", "list_id", "vector").mapInArrow(run, "shard_id int, list_id int, near double, far double")
    return parts.groupBy("shard_id", "list_id").agg(F.min("near").alias("near"), F.max("far").alias("far"))


def shell_probe(index: VectorIndex, qs: DataFrame, cents: DataFrame, radius: float) -> DataFrame:
    """The lists whose shell the ball around the query meets (for centroids within the broadcast budget)."""
    squared = index.metric == "l2"
    reach = float(np.sqrt(max(radius, 0.0))) if squared else radius
    memo = index.extra.get("memo", {})
    shells = memo["shells"] if "shells" in memo else list_shells(index, cents)
    if "memo" in index.extra and "shells" not in memo:
        memo["shells"] = shells = index.spark.createDataFrame(shells.toArrow())

    def pick(order, d, facts):
        near, far = facts[0][order], facts[1][order]
        d = np.sqrt(d) if squared else d
        slack = 1e-9 * (1 + d + far)
        return (d - far < reach + slack) & (near - d < reach + slack)

    return _chosen(index, qs, cents.join(shells, ["shard_id", "list_id"]), ["near", "far"], pick)
