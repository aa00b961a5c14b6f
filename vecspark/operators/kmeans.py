"""Lloyd k-means as DataFrame work, one independent clustering per group.

Init: the rows at positions ``i*(n-1) div (nlist-1)`` (i = 0..nlist-1) of
each group in id order (``nlist = 1``: position 0), so a build is
deterministic and has a SQL oracle.  Each iteration assigns every row to
its nearest centroid (ties to the lower ``list_id``) and replaces each
centroid by the mean of its rows; an empty list keeps its centroid.

When the centroids of all groups fit the broadcast budget (they are
``groups x nlist x dim`` doubles, known before the job), each iteration is
one pass over the training rows: a ``mapInArrow`` task assigns its rows and
adds them up per list, emitting one partial row per list (among very many
centroids the nearest is found by cells, see ``functions.cells``).  Beyond the budget,
rows are assigned with the tiled plan of ``nearest`` and added up per task.
The partial sums are added as a tree over the tasks: a round adds those of at
most ``FAN_IN`` neighbouring tasks for each list, in the order of the tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions import cells, kernels
from vecspark.model import CENTROID_TYPE
from vecspark.operators import nearest as nn
from vecspark.operators.ranking import positions
from vecspark.session import checkpoint_dir, ensure_importable

FAN_IN = 64  # tasks (or nodes of the round before) whose sums of a list are added in one place


def centroids_fit(spark, rows: int, dim: int) -> bool:
    return nn.side_bytes(rows, dim) <= nn.broadcast_budget(spark)


def assign_lists(df: DataFrame, centroids: DataFrame, *, dim: int, metric: str, group_keys=(),
                 vec_col: str = "_v", id_col: str = "_id", out_col: str = "list_id",
                 centroid_rows: int | None = None, strategy: str = "auto") -> DataFrame:
    """``df`` plus ``out_col``: the nearest centroid of the row's group.

    ``centroids`` has ``group_keys + [list_id, centroid]``.
    """
    group_keys = list(group_keys)
    spark = df.sparkSession
    ensure_importable(spark)
    if strategy == "auto":
        if centroid_rows is None:
            centroid_rows = centroids.count()
        strategy = "broadcast" if centroids_fit(spark, centroid_rows, dim) else "tiled"
    if strategy == "broadcast":
        bc = _broadcast_centroids(spark, centroids, dim, group_keys, metric)
        out_schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.IntegerType(), True)])

        def run(batches):
            cents = bc.value
            preps = {}
            for rb in batches:
                n = rb.num_rows
                out = np.full(n, -1, np.int64)
                if n:
                    vecs = kernels.list_matrix(rb.column(vec_col), dim)
                    gk = [rb.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in group_keys]
                    for kv, rows in kernels.group_rows(gk):
                        rows = np.arange(n)[rows]
                        got = cents.get(kv)
                        if got is None:
                            continue
                        lid, cm, layout = got
                        if kv not in preps:
                            preps[kv] = cells.Nearest(cm, lid, metric, layout)
                        found = preps[kv].search(vecs[rows])
                        out[rows[found >= 0]] = lid[found[found >= 0]]
                mask = out < 0
                arr = pa.array(out.astype(np.int32), mask=mask)
                yield pa.RecordBatch.from_arrays(rb.columns + [arr], names=rb.schema.names + [out_col])

        return df.mapInArrow(run, out_schema)
    # Tiled: nearest centroid per row, then attach it back by a row identity (ids may repeat), written once.
    checkpoint_dir(spark)
    columns = df.columns
    df = df.withColumn("_rid", F.monotonically_increasing_id()).checkpoint(eager=True)
    q = df.select(*group_keys, F.col("_rid").alias("_qid"), F.col(vec_col).alias("_qv"))
    items = centroids.select(*group_keys, F.col("list_id").cast("long").alias("_id"),
                             F.col("centroid").alias("_v"))
    best = nn.nearest(q, items, dim=dim, metric=metric, k=1, join_keys=group_keys, per_keys=group_keys,
                      strategy="tiled")
    best = best.select(F.col("_qid").alias("_rid"), F.col("_id").cast("int").alias(out_col))
    return df.join(best, "_rid", "left").select(*columns, out_col)


def initial_centroids(train: DataFrame, *, nlist: int, group_keys=(), groups: int | None = None) -> DataFrame:
    """Rows at evenly spaced positions of each group in id order.

    Positions are computed on the keys only; vectors are joined back for the
    ``nlist`` chosen rows per group.
    """
    group_keys = list(group_keys)
    if nlist == 1:  # position 0 in id order is the smallest id: no global numbering needed
        chosen = train.groupBy(*group_keys).agg(F.min("_id").alias("_id")).withColumn("list_id", F.lit(0))
        return _vectors_of(chosen, train, group_keys)
    pos = positions(train, ["_id"], group_keys, groups=groups)
    counts = pos.groupBy(*group_keys).agg(F.count(F.lit(1)).alias("_n"))
    step = (F.col("list_id") * (F.col("_n") - 1)).cast("long")
    targets = (counts
               .withColumn("_n", F.when(F.col("_n") < nlist, F.raise_error(F.format_string(
                   "k-means needs at least %d training vectors per group, got %d", F.lit(nlist), F.col("_n"))))
                           .otherwise(F.col("_n")))
               .withColumn("list_id", F.explode(F.sequence(F.lit(0), F.lit(nlist - 1))))
               .withColumn("_pos", F.lit(0).cast("long") if nlist == 1 else F.floor(step / (nlist - 1)).cast("long")))
    chosen = targets.join(pos, group_keys + ["_pos"]).select(*group_keys, "list_id", "_id")
    return _vectors_of(chosen, train, group_keys)


def _vectors_of(chosen: DataFrame, train: DataFrame, group_keys) -> DataFrame:
    """The chosen ids' vectors, one per list also where rows repeat an id (the smallest)."""
    rows = chosen.join(train.select(*group_keys, "_id", "_v"), group_keys + ["_id"])
    return (rows.groupBy(*group_keys, F.col("list_id").cast("int").alias("list_id"))
            .agg(F.min(F.col("_v").cast(CENTROID_TYPE)).alias("centroid")))


def update_centroids(assigned: DataFrame, old: DataFrame, *, dim: int, group_keys=()) -> DataFrame:
    """Mean of the rows of each list; a list without rows keeps its centroid (tiled path).

    Lists are added up per task before the shuffle: a hot list sends one row
    per task and batch.
    """
    group_keys = list(group_keys)
    keys = [*group_keys, "list_id"]
    rows = assigned.where(F.col("list_id").isNotNull()).select(*keys, F.col("_v").cast(CENTROID_TYPE).alias("_sum"))
    types = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField(k, types[k], True) for k in keys] + [
        T.StructField("_cnt", T.LongType(), False), T.StructField("_sum", CENTROID_TYPE, False)])

    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            vecs = kernels.list_matrix(rb.column("_sum"), dim)
            cols = [rb.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys]
            order = np.lexsort(cols[::-1])
            cols = [c[order] for c in cols]
            new = np.zeros(len(order), dtype=bool)
            new[0] = True
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(new)
            sums = np.add.reduceat(vecs[order], starts, axis=0)
            arrays = [pa.array(c[starts]).cast(rb.column(k).type) for c, k in zip(cols, keys)]
            arrays += [pa.array(np.diff(np.r_[starts, len(order)]), type=pa.int64()),
                       pa.FixedSizeListArray.from_arrays(pa.array(sums.reshape(-1)), dim).cast(pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, "_cnt", "_sum"])

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the assignment ends in a shuffled join
    return combine_sums(rows.mapInArrow(run, schema), old, dim=dim, group_keys=group_keys, tasks=tasks)


def _broadcast_centroids(spark, centroids: DataFrame, dim: int, group_keys, metric: str):
    """``{group: (list ids, centroids, layout of their cells)}``."""
    tbl = centroids.select(*group_keys, "list_id", "centroid").toArrow()
    keys = [tbl.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in group_keys]
    lists = tbl.column("list_id").to_numpy(zero_copy_only=False).astype(np.int64)
    mat = kernels.list_matrix(tbl.column("centroid"), dim)
    return spark.sparkContext.broadcast({kv: (lists[rows], mat[rows], cells.layout(mat[rows], metric))
                                         for kv, rows in kernels.group_rows(keys)})


def partial_sums(train: DataFrame, centroids: DataFrame, *, dim: int, metric: str, group_keys=()) -> DataFrame:
    """Assignment fused with the map side of the update (broadcast centroids).

    Each task emits one row ``group_keys..., list_id, _cnt, _sum`` per list it
    saw, instead of one row per training vector.
    """
    group_keys = list(group_keys)
    spark = train.sparkSession
    ensure_importable(spark)
    bc = _broadcast_centroids(spark, centroids, dim, group_keys, metric)
    key_types = {f.name: f.dataType for f in train.schema.fields}
    schema = T.StructType([T.StructField(k, key_types[k], True) for k in group_keys] + [
        T.StructField("list_id", T.IntegerType(), False), T.StructField("_cnt", T.LongType(), False),
        T.StructField("_sum", CENTROID_TYPE, False)])
    arrow_types = {k: (pa.int32() if isinstance(key_types[k], T.IntegerType) else pa.int64()) for k in group_keys}

    def run(batches):
        cents = bc.value
        preps = {}
        acc = {}
        for rb in batches:
            n = rb.num_rows
            if not n:
                continue
            vecs = kernels.list_matrix(rb.column("_v"), dim)
            gk = [rb.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in group_keys]
            for kv, rows in kernels.group_rows(gk):
                got = cents.get(kv)
                if got is None:
                    raise ValueError(f"no centroids for group {kv}")
                rows = np.arange(n)[rows]
                lid, cm, layout = got
                if kv not in preps:
                    preps[kv] = cells.Nearest(cm, lid, metric, layout)
                slot = preps[kv].search(vecs[rows])
                if (slot < 0).any():
                    raise ValueError("k-means: a training vector has NaN or infinite components")
                cnt = np.bincount(slot, minlength=len(lid))
                order = np.argsort(slot, kind="stable")
                sorted_slot = slot[order]
                starts = np.flatnonzero(np.r_[True, sorted_slot[1:] != sorted_slot[:-1]])
                sums = np.zeros((len(lid), dim))
                sums[sorted_slot[starts]] = np.add.reduceat(vecs[rows][order], starts, axis=0)
                prev = acc.get(kv)
                acc[kv] = (cnt, sums) if prev is None else (prev[0] + cnt, prev[1] + sums)
        cols = {k: [] for k in group_keys}
        out_l, out_n, out_s = [], [], []
        for kv, (cnt, sums) in acc.items():
            lid = cents[kv][0]
            hit = np.flatnonzero(cnt)
            for k, v in zip(group_keys, kv):
                cols[k].append(np.full(len(hit), v, np.int64))
            out_l.append(lid[hit])
            out_n.append(cnt[hit])
            out_s.append(sums[hit])
        if not out_l:
            return
        sums = np.concatenate(out_s)
        arrays = [pa.array(np.concatenate(cols[k]), type=arrow_types[k]) for k in group_keys]
        arrays += [pa.array(np.concatenate(out_l), type=pa.int32()), pa.array(np.concatenate(out_n), type=pa.int64()),
                   pa.FixedSizeListArray.from_arrays(pa.array(sums.reshape(-1)), dim).cast(pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=group_keys + ["list_id", "_cnt", "_sum"])

    return train.select(*group_keys, "_v").mapInArrow(run, schema)


def add_sums(sums: DataFrame, keys, *, dim: int, last: bool = False) -> DataFrame:
    """One round of the tree: the rows ``keys, _task, _cnt, _sum`` of ``FAN_IN`` neighbouring tasks become one per list.

    The ``last`` round leaves one row a list, whatever the number of tasks was taken to be.
    Rows arrive sorted, so a task holds one batch and one open sum, and rows
    are added in a fixed order: a build is deterministic.
    """
    keys = list(keys)
    node = F.lit(0) if last else F.floor(F.col("_task") / FAN_IN).cast("int")
    rows = sums.select(*keys, node.alias("_node"), F.col("_task").alias("_order"), "_cnt", "_sum")
    by = [*keys, "_node"]
    dealt = rows.repartition(*by).sortWithinPartitions(*by, "_order", "_cnt", "_sum").select(*by, "_cnt", "_sum")

    def emitted(types, where, counts, vecs):
        arrays = [pa.array(c).cast(t) for c, t in zip(where, types)]
        arrays += [pa.array(counts, type=pa.int64()),
                   pa.FixedSizeListArray.from_arrays(pa.array(vecs.reshape(-1)), dim).cast(pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(arrays, names=[*by, "_cnt", "_sum"])

    def run(batches):
        held, types = None, None
        for rb in batches:
            if not rb.num_rows:
                continue
            types = [rb.column(k).type for k in by]
            where = np.stack([rb.column(k).to_numpy().astype(np.int64) for k in by])
            counts, vecs = rb.column("_cnt").to_numpy(), kernels.list_matrix(rb.column("_sum"), dim)
            if held is not None:
                where, counts, vecs = np.c_[held[0], where], np.r_[held[1], counts], np.r_[held[2], vecs]
            starts = np.r_[0, np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1]
            where, counts, vecs = where[:, starts], np.add.reduceat(counts, starts), np.add.reduceat(vecs, starts, axis=0)
            if len(starts) > 1:
                yield emitted(types, where[:, :-1], counts[:-1], vecs[:-1])
            held = where[:, -1:], counts[-1:], vecs[-1:]
        if held is not None:
            yield emitted(types, *held)

    return dealt.mapInArrow(run, dealt.schema).withColumnRenamed("_node", "_task")


def combine_sums(partials: DataFrame, old: DataFrame, *, dim: int, group_keys=(), tasks: int) -> DataFrame:
    """Reduce side of the update: add the partial sums of ``tasks`` tasks per list and divide."""
    keys = [*group_keys, "list_id"]
    sums = partials.withColumn("_task", F.spark_partition_id()).select(*keys, "_task", "_cnt", "_sum")
    while tasks > FAN_IN:
        sums, tasks = add_sums(sums, keys, dim=dim), -(-tasks // FAN_IN)
    sums = add_sums(sums, keys, dim=dim, last=True)
    means = sums.select(*keys, F.transform("_sum", lambda x: x / F.col("_cnt")).alias("_mean"))
    return (old.join(means, keys, "left")
            .select(*keys, F.coalesce("_mean", "centroid").alias("centroid")))


def kmeans(train: DataFrame, *, dim: int, nlist: int, iterations: int, metric: str = "l2",
           group_keys=(), groups: int | None = None) -> DataFrame:
    """Centroids ``group_keys + [list_id, centroid]`` after ``iterations`` Lloyd steps.

    ``train`` has ``group_keys + [_id, _v]``; ids must be unique per group.
    The training rows are persisted for the iterations (recomputed from
    lineage if an executor is lost) and released at the end.
    """
    group_keys = list(group_keys)
    spark = train.sparkSession
    if groups is None:
        groups = train.select(*group_keys).distinct().count() if group_keys else 1
    rows = groups * nlist
    small = centroids_fit(spark, rows, dim)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cents = _settle(initial_centroids(train, nlist=nlist, group_keys=group_keys, groups=groups), small)
        tasks = train.rdd.getNumPartitions() if small else None
        for _ in range(iterations):
            if small:
                part = partial_sums(train, cents, dim=dim, metric=metric, group_keys=group_keys)
                cents = _settle(combine_sums(part, cents, dim=dim, group_keys=group_keys, tasks=tasks), small)
            else:
                assigned = assign_lists(train, cents, dim=dim, metric=metric, group_keys=group_keys,
                                        centroid_rows=rows, strategy="tiled")
                cents = _settle(update_centroids(assigned, cents, dim=dim, group_keys=group_keys), small)
    finally:
        train.unpersist()
    return cents


def _settle(cents: DataFrame, small: bool) -> DataFrame:
    """Cut the lineage of one iteration's centroids.

    Small centroid tables are collected (they are broadcast next anyway) and
    rebuilt as a local relation; large ones are checkpointed to the shared
    checkpoint folder.
    """
    spark = cents.sparkSession
    if small:
        tbl = cents.toArrow()
        return spark.createDataFrame(tbl).select(
            *[F.col(c) for c in tbl.column_names if c not in ("list_id", "centroid")],
            F.col("list_id").cast("int"), F.col("centroid").cast(CENTROID_TYPE))
    checkpoint_dir(spark)
    return cents.checkpoint(eager=True)
