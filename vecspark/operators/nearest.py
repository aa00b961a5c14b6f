"""Nearest-partner search between two DataFrames of vectors.

``nearest(queries, items, ...)`` is the one physical operator every search,
k-means assignment, IVF probe and PQ encode goes through.  It never emits
all pairs: each task holds two bounded blocks and emits only the best
partners (or the in-radius partners) of each query.  Three plans, chosen
by checked sizes:

``broadcast_items``   the item side is small (centroids, codebooks, a small
                      index): it is broadcast and the queries are streamed
                      with ``mapInArrow``; every query row is finished in
                      its own batch.
``broadcast_queries`` the query side is small (a batch of queries against a
                      large index): the queries are broadcast and the
                      postings are scanned in place with ``mapInArrow`` (no
                      shuffle of the postings); each task keeps a running
                      top-k per query and emits it once, and a final
                      ``row_number`` window merges those partial lists.
``tiled``             both sides are large: items and queries of each
                      join-key group (a shard's list, say) are cut into
                      tiles of bounded size by hashing their ids; a hot group
                      gets as many tiles as its size needs, and large work
                      is cut into at least two tiles per core.  A tile's rows are
                      sorted, queries first: a task holds one query tile with
                      its running results, and the items stream past it in
                      Arrow batches, in their stored form (codes stay codes).

The second and third plan are the same search, ``_searched``; it keeps each
query's best ``k`` and looks only for what is nearer than the ``k``-th so far.
A side that grows with the table is broadcast up to ``DEFAULT_BATCH_BYTES``.

Inputs: ``queries`` has ``join_keys + [_qid, _qv]``; ``items`` has
``join_keys + per_keys + [_id, _v]``.  Output: ``per_keys + [_qid, _id, _d,
_rank]``, the best ``k`` per ``(_qid, per_keys)`` (or every hit within the
radius, ranked).  ``_qid`` identifies a query row; a ``_qlab`` column of the
queries (the user's query id, which may repeat) is carried to the output.
"""

from __future__ import annotations

import itertools
import math
import warnings

import numpy as np
import pyarrow as pa
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions import kernels
from vecspark.session import checkpoint_dir, ensure_importable

DEFAULT_BROADCAST_BYTES = 128 << 20
DEFAULT_BATCH_BYTES = 16 << 20  # a counted side that is broadcast: every Python worker holds it, and its results
DEFAULT_TILE_BYTES = 32 << 20
TILE_PAIRS = 20_000_000  # work below which a tile is not cut further for the sake of more tasks
RADIUS_BLOCK = 512  # rows of a streamed batch searched at once in a radius search
REDUCE_AT = 1 << 19  # hits of a radius search that leave a task at once
GATHER_AT = 1 << 20  # hits that leave a task as arrays at once
SCAN_RANGES = 8
ARRAYS = T.StructType([T.StructField("_qid", T.LongType(), False), T.StructField("_ids", T.ArrayType(T.LongType())),
                       T.StructField("_ds", T.ArrayType(T.DoubleType()))])


def _conf_int(spark, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def broadcast_budget(spark) -> int:
    """Largest side (bytes, float64 vectors) that may be broadcast."""
    return _conf_int(spark, "vecspark.broadcast.maxBytes", DEFAULT_BROADCAST_BYTES)


def tile_rows(spark, dim: int, hits: int = 0) -> int:
    """Rows of a tile of vectors, with ``hits`` results held per row."""
    return max(1, _conf_int(spark, "vecspark.tile.bytes", DEFAULT_TILE_BYTES) // (8 * dim + 16 + 16 * hits))


def side_bytes(rows: int, dim: int, hits: int = 0) -> int:
    """Bytes of a broadcast side: its vectors, and ``hits`` results held per row."""
    return rows * (8 * dim + 16 + 40 * hits)


def sized_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` as a broadcast side where it fits the budget, else as it is (a shuffled join).

    ``rows`` is a known bound of the rows; without it they are counted, strings
    and binaries with their lengths.
    """
    row_bytes = 16 + 16 * len(df.columns)
    if rows is not None:
        size = rows * row_bytes
    else:
        long = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields
                if isinstance(f.dataType, (T.StringType, T.BinaryType))]
        size = df.agg(F.sum(sum(long, F.lit(row_bytes)))).first()[0] or 0
    return F.broadcast(df) if size <= broadcast_budget(df.sparkSession) else df


LABEL = "_qlab"


def _labels(df: DataFrame) -> list[str]:
    return [LABEL] if LABEL in df.columns else []


def _schema(per_keys, key_types) -> T.StructType:
    fields = [T.StructField(k, key_types[k], True) for k in per_keys]
    fields += [
        T.StructField("_qid", T.LongType(), False),
        T.StructField("_id", T.LongType(), False),
        T.StructField("_d", T.DoubleType(), False),
        T.StructField("_rank", T.IntegerType(), False),
    ]
    return T.StructType(fields)


def _collect_side(df: DataFrame, key_cols, id_col, vec_col, dim, tbl: pa.Table | None = None):
    """Collect a size-checked side to the driver as NumPy (float64 vectors)."""
    if tbl is None:
        tbl = df.select(*key_cols, id_col, vec_col, *_labels(df)).toArrow()
    return {
        "keys": [tbl.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in key_cols],
        "ids": tbl.column(id_col).to_numpy(zero_copy_only=False).astype(np.int64),
        "vecs": kernels.list_matrix(tbl.column(vec_col), dim),
        "labels": tbl.column(LABEL).combine_chunks() if LABEL in tbl.column_names else None,
    }


def _labelled(batch: pa.RecordBatch, labels, qpos) -> pa.RecordBatch:
    """``batch`` with the labels of its query positions, if there are any."""
    if labels is None:
        return batch
    if isinstance(labels, pa.ChunkedArray):
        labels = labels.combine_chunks()
    return pa.RecordBatch.from_arrays([*batch.columns, labels.take(pa.array(qpos, type=pa.int64()))],
                                      names=[*batch.schema.names, LABEL])


def _batch(per_vals, qids, ids, d, ranks, per_keys, kinds):
    cols = [pa.array(v, type=pa.int32() if kinds[k] == "int" else pa.int64())
            for k, v in zip(per_keys, per_vals)]
    cols += [pa.array(qids, type=pa.int64()), pa.array(ids, type=pa.int64()),
             pa.array(d, type=pa.float64()), pa.array(ranks, type=pa.int32())]
    names = list(per_keys) + ["_qid", "_id", "_d", "_rank"]
    return pa.RecordBatch.from_arrays(cols, names=names)


def _ranks_of(qkey: np.ndarray) -> np.ndarray:
    """1-based position within runs of equal (sorted) keys."""
    if len(qkey) == 0:
        return np.zeros(0, np.int32)
    starts = np.r_[0, np.flatnonzero(np.diff(qkey)) + 1]
    run = np.repeat(starts, np.diff(np.r_[starts, len(qkey)]))
    return (np.arange(len(qkey)) - run + 1).astype(np.int32)


class _Acc:
    """Collects (query position, per-key values, id, distance) candidate rows."""

    def __init__(self, n_per):
        self.parts = []
        self.n_per = n_per

    def add(self, qpos, per_vals, ids, d):
        if len(qpos):
            self.parts.append((qpos, per_vals, ids, d))

    def arrays(self):
        if not self.parts:
            z = np.zeros(0, np.int64)
            return z, [z] * self.n_per, z, np.zeros(0)
        qpos = np.concatenate([p[0] for p in self.parts])
        per = [np.concatenate([p[1][i] for p in self.parts]) for i in range(self.n_per)]
        ids = np.concatenate([p[2] for p in self.parts])
        d = np.concatenate([p[3] for p in self.parts])
        return qpos, per, ids, d

    def reduce(self, k, larger):
        """Keep the best k per (query position, per-key values); returns sorted arrays."""
        qpos, per, ids, d = self.arrays()
        if len(qpos) == 0:
            return qpos, per, ids, d, np.zeros(0, np.int32)
        if per:
            _, gkey = np.unique(np.stack([qpos] + per, axis=1), axis=0, return_inverse=True)
            gkey = gkey.reshape(-1)
        else:
            gkey = qpos
        primary = -d if larger else d
        order = np.lexsort((ids, primary, gkey))
        gkey, qpos, ids, d = gkey[order], qpos[order], ids[order], d[order]
        per = [p[order] for p in per]
        ranks = _ranks_of(gkey)
        if k is not None:
            keep = ranks <= k
            qpos, ids, d, ranks = qpos[keep], ids[keep], d[keep], ranks[keep]
            per = [p[keep] for p in per]
        self.parts = [(qpos, per, ids, d)]
        return qpos, per, ids, d, ranks


def prepare_side(side: dict, group_idx, sub_idx, metric: str) -> dict:
    """Group a broadcast side once: ``{group key: [(sub key, row positions, ids, vectors, prep), ...]}``.

    Rows are copied into one contiguous block per (group, sub-group) and the
    kernel's per-block values are precomputed, so every streamed batch
    reuses them.
    """
    keys = side["keys"]
    out = {}
    for gk, rows in kernels.group_rows([keys[i] for i in group_idx]):
        rows = np.arange(len(side["ids"]))[rows]
        parts = []
        for sk, srows in kernels.group_rows([keys[i][rows] for i in sub_idx]):
            sel = rows[srows] if sub_idx else rows
            whole = len(sel) == len(side["ids"]) and bool(np.all(sel == np.arange(len(sel))))
            vecs = side["vecs"] if whole else np.ascontiguousarray(side["vecs"][sel])  # no copy for one group
            parts.append((sk, sel, side["ids"][sel], vecs, kernels.prepare_items(vecs, metric)))
        out[gk] = parts
    return out


def _search_groups(acc, qmat, qkeys, qrows_all, prepared, metric, k, radius):
    """Run the block kernel for every join-key group present on both sides.

    ``qmat``/``qkeys`` are the query block and its join-key columns;
    ``prepared`` is the item side grouped by ``prepare_side``.
    """
    for kv, qrows in kernels.group_rows(qkeys):
        parts = prepared.get(kv)
        if parts is None:
            continue
        qrows = qrows_all[qrows]
        qm = qmat[qrows]
        for pv, _, ids, vecs, prep in parts:
            qi, vi, d = kernels.search_block(qm, vecs, ids, metric, k=k, radius=radius, prep=prep)
            acc.add(qrows[qi], [np.full(len(qi), x, np.int64) for x in pv], ids[vi], d)


def nearest(queries: DataFrame, items: DataFrame, *, dim: int, metric: str,
            k: int | None = None, radius: float | None = None,
            join_keys=(), per_keys=(), strategy: str = "auto",
            items_rows: int | None = None, queries_unique: bool = True, final: bool = True,
            carry_query_vector: bool = False, item_transform=None, item_search=None, shards: int = 1,
            queries_bound: int | None = None, item_groups: int | None = None, items_table: pa.Table | None = None,
            limits: tuple[np.ndarray, np.ndarray] | None = None, arrays: bool = False) -> DataFrame:
    """Best partners of each query row among the items (see module doc).

    ``queries_unique`` says each ``_qid`` occurs in one query row; then the
    ``broadcast_items`` plan finishes every query inside its batch and needs
    no final merge.  ``final=False`` returns the partial lists unmerged.
    ``carry_query_vector`` asks the ``broadcast_items`` plan to copy each
    hit's query vector into a ``_qv`` column (an IVF probe feeds it straight
    to the list search, with no join back to the queries); other plans
    ignore it, so callers check for the column.  ``item_transform`` turns the
    stored item rows into ``_v`` rows (PQ decoding).  ``item_search`` (see
    ``VectorSearch``) searches the stored columns inside a task instead: the
    ``broadcast_queries`` plan reads those of the probed lists only.  ``shards``
    bounds the lists a query has in one task (``per_keys`` groups), for the size
    check; ``queries_bound`` is a known bound of the query rows, which are then
    not counted; ``item_groups`` the number of join groups that exist;
    ``items_table`` the item side where it is at hand already.  ``limits``
    (sorted ``_qid``s and distances) are known k-th distances: the
    ``broadcast_queries`` plan sends nothing on that is farther.  ``arrays`` (of
    a radius search) returns rows ``_qid, _ids, _ds`` instead, unmerged and in
    no order: a task hands on a query's hits as two arrays, some at a time.
    """
    if arrays and (radius is None or per_keys):
        raise ValueError("arrays are those of a radius search over all items")
    if (k is None) == (radius is None):
        raise ValueError("give exactly one of k and radius")
    join_keys, per_keys = list(join_keys), list(per_keys)
    spark = queries.sparkSession
    ensure_importable(spark)
    larger = kernels.larger_is_nearer(metric)
    key_types = {f.name: f.dataType for f in items.schema.fields}
    kinds = {kname: ("int" if isinstance(key_types[kname], T.IntegerType) else "long") for kname in per_keys}
    schema = _schema(per_keys, key_types)
    budget = broadcast_budget(spark)

    raw_items = items
    if item_transform is not None:
        items = item_transform(items)
    collected = None
    if strategy == "auto":
        strategy, collected = choose_strategy(queries, items, dim, budget, items_rows, join_keys, per_keys,
                                              hits=(k or 1) * (shards if per_keys else 1),
                                          queries_bound=queries_bound, items_table=items_table)

    if strategy == "broadcast_items":
        out, complete = _broadcast_items(queries, items, dim, metric, k, radius, join_keys, per_keys,
                                         kinds, schema, larger, collected, carry_query_vector, arrays), queries_unique
    elif strategy == "broadcast_queries":
        out, complete = _broadcast_queries(queries, raw_items, dim, metric, k, radius, join_keys, per_keys,
                                           kinds, schema, larger, collected, item_transform, item_search, item_groups, limits, arrays), False
    elif strategy == "tiled":
        out, complete = _tiled(queries, items if item_search is None else raw_items, dim, metric, k, radius, join_keys,
                               per_keys, kinds, schema, larger, item_search, (k or 0) * (shards if per_keys else 1), arrays), False
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    if arrays or complete or not final:
        return out
    return rank_final(out, k, per_keys, larger)


def choose_strategy(queries: DataFrame, items: DataFrame, dim: int, budget: int,
                    items_rows: int | None = None, join_keys=(), per_keys=(), hits: int = 1,
                    queries_bound: int | None = None, items_table: pa.Table | None = None):
    """Pick a plan from counted sizes; returns ``(strategy, collected side or None)``.

    An item side of known small size (centroids, codebooks) is broadcast
    within ``budget``; sides that grow with the tables within
    ``vecspark.search.maxBytes`` as well.  The queries are counted: a batch of queries that fits, with the
    ``hits`` per query that a task holds, is broadcast and the item side (a
    large index) is streamed in place and never counted.  Only when the
    queries do not fit are the items counted; if neither fits, the tiled plan
    is used.
    """
    if items_rows is not None and side_bytes(items_rows, dim) <= budget:
        return "broadcast_items", items_table
    budget = min(budget, _conf_int(queries.sparkSession, "vecspark.search.maxBytes", DEFAULT_BATCH_BYTES))
    if queries_bound is None or side_bytes(queries_bound, dim, hits) > budget:
        queries_bound = queries.count()
    if side_bytes(queries_bound, dim, hits) <= budget:
        return "broadcast_queries", queries.select(*join_keys, "_qid", "_qv", *_labels(queries)).toArrow()
    if items_rows is None and side_bytes(items.count(), dim) <= budget:
        return "broadcast_items", items.select(*_item_keys(join_keys, per_keys)[0], "_id", "_v").toArrow()
    return "tiled", None


class VectorSearch:
    """How a task searches item rows: ``columns`` to read, ``open`` a batch, ``search`` some of its rows for a query block."""

    columns = ("_v",)

    def __init__(self, dim: int):
        self.dim = dim

    def open(self, rb: pa.RecordBatch) -> np.ndarray:
        return kernels.list_matrix(rb.column("_v"), self.dim)

    def prepare(self, opened, rows, metric):
        """What the search of these rows needs, once for all query blocks."""
        vecs = opened[rows]
        return vecs, kernels.prepare_items(vecs, metric)

    def search(self, qm, prepared, ids, group, metric, k, radius, limit=None):
        """Best or near partners of a query block; ``limit`` are known k-th distances."""
        vecs, prep = prepared
        return kernels.search_block(qm, vecs, ids, metric, k=k, radius=radius, prep=prep, limit=limit)


def scan_filter(scan: DataFrame, key_cols, keys: list[np.ndarray], groups: int | None = None) -> DataFrame:
    """Only rows of the groups that some query asks for (an IVF probe's lists).

    At most ``SCAN_RANGES`` value ranges per key, cut at the widest gaps, reach
    the Parquet scan as a plain predicate whatever the number of groups; a
    semi-join with the broadcast groups (no more rows than the broadcast
    queries) then keeps exactly those.  Where most of the ``groups`` that exist
    are asked for, the scan stays as it is: a task passes over the others.
    """
    if not key_cols:
        return scan
    spark = scan.sparkSession
    wanted = np.unique(np.stack(keys, axis=1), axis=0) if len(keys[0]) else np.zeros((0, len(keys)), np.int64)
    if not len(wanted):
        return scan.where(F.lit(False))
    if groups is not None and 2 * len(wanted) >= groups:
        return scan
    for pos, key in enumerate(key_cols):
        values = np.unique(wanted[:, pos])
        gaps = np.diff(values)
        cuts = np.sort(np.argsort(-gaps, kind="stable")[:SCAN_RANGES - 1]) if len(gaps) else np.zeros(0, np.int64)
        cuts = cuts[gaps[cuts] > 1]
        near = F.lit(False)
        for a, b in zip(np.r_[0, cuts + 1], np.r_[cuts, len(values) - 1]):
            near = near | F.col(key).between(int(values[a]), int(values[b]))
        scan = scan.where(near)
    table = pa.table({k: pa.array(wanted[:, i]) for i, k in enumerate(key_cols)})
    groups = spark.createDataFrame(table).select(*[F.col(k).cast(scan.schema[k].dataType) for k in key_cols])
    return scan.join(F.broadcast(groups), list(key_cols), "left_semi")


def rank_final(cands: DataFrame, k: int | None, per_keys, larger: bool) -> DataFrame:
    """Merge partial candidate lists: best k per (query, per_keys) by (distance, id).

    Spark plans ``row_number() <= k`` as a partial ``WindowGroupLimit``
    below the exchange, so each task ships at most k rows per query.
    """
    if k is not None:
        spark = cands.sparkSession
        limit = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
        if k > limit:
            warnings.warn(f"k={k} exceeds spark.sql.optimizer.windowGroupLimitThreshold={limit}: the partial "
                          "top-k below the shuffle is off and every candidate row is shuffled; raise the setting",
                          stacklevel=3)
    order = F.col("_d").desc() if larger else F.col("_d").asc()
    w = Window.partitionBy("_qid", *per_keys).orderBy(order, F.col("_id").asc())
    ranked = cands.drop("_rank").withColumn("_rank", F.row_number().over(w))
    if k is not None:
        ranked = ranked.where(F.col("_rank") <= k)
    return ranked


def _broadcast_items(queries, items, dim, metric, k, radius, join_keys, per_keys, kinds, schema, larger,
                     collected=None, carry=False, arrays=False):
    spark = queries.sparkSession
    item_keys, join_idx, per_idx = _item_keys(join_keys, per_keys)
    side = _collect_side(items, item_keys, "_id", "_v", dim, collected)
    bc = spark.sparkContext.broadcast(side)
    if carry:
        qv_field = queries.schema["_qv"]
        schema = T.StructType(schema.fields + [T.StructField("_qv", qv_field.dataType, True)])
    labels = _labels(queries)
    schema = T.StructType(schema.fields + [queries.schema[c] for c in labels])

    def run(batches):
        prepared = None
        for rb in _pieces(batches, radius):
            if prepared is None:
                prepared = prepare_side(bc.value, join_idx, per_idx, metric)
            qmat = kernels.list_matrix(rb.column("_qv"), dim)
            qids = rb.column("_qid").to_numpy(zero_copy_only=False).astype(np.int64)
            qkeys = [rb.column(kk).to_numpy(zero_copy_only=False).astype(np.int64) for kk in join_keys]
            acc = _Acc(len(per_keys))
            _search_groups(acc, qmat, qkeys, np.arange(rb.num_rows), prepared, metric, k, radius)
            qpos, per, ids, d, ranks = acc.reduce(k, larger)
            out = _batch(per, qids[qpos], ids, d, ranks, per_keys, kinds)
            if carry:
                out = pa.RecordBatch.from_arrays(out.columns + [rb.column("_qv").take(pa.array(qpos))],
                                                 names=out.schema.names + ["_qv"])
            yield _labelled(out, rb.column(LABEL) if labels else None, qpos)

    return _mapped(queries.select(*join_keys, "_qid", "_qv", *labels), run, schema, arrays)


def _mapped(rows, run, schema, arrays):
    """``rows`` searched by ``run``, its hits one a row or as arrays."""
    if not arrays:
        return rows.mapInArrow(run, schema)
    return rows.mapInArrow(lambda batches: _gathered(run(batches)), ARRAYS)


def _gathered(batches):
    """Hits as one row a query, of ``GATHER_AT`` hits at a time."""
    held, count = [], 0
    for rb in batches:
        if rb.num_rows:
            held.append(rb.select(["_qid", "_id", "_d"]))
            count += rb.num_rows
        if count >= GATHER_AT:
            yield _by_query(held)
            held, count = [], 0
    if held:
        yield _by_query(held)


def _by_query(held) -> pa.RecordBatch:
    hits = pa.Table.from_batches(held)
    qids, ids, d = (hits.column(c).to_numpy() for c in ("_qid", "_id", "_d"))
    order = np.argsort(qids, kind="stable")
    qids = qids[order]
    starts = np.r_[0, np.flatnonzero(np.diff(qids)) + 1]
    ends = pa.array(np.r_[starts, len(qids)], type=pa.int32())
    lists = [pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (ids, d)]
    return pa.RecordBatch.from_arrays([pa.array(qids[starts]), *lists], names=ARRAYS.names)


def _pieces(batches, radius):
    """Non-empty batches; in a radius search, where anything can hit, cut to ``RADIUS_BLOCK`` rows."""
    for rb in batches:
        for at in range(0, rb.num_rows, RADIUS_BLOCK if radius is not None else max(1, rb.num_rows)):
            yield rb.slice(at, RADIUS_BLOCK) if radius is not None else rb


class _Best:
    """The best ``k`` (distance, id) so far of each query and per-key group, and the k-th distance (at first ``start``)."""

    def __init__(self, start: np.ndarray, k: int, larger: bool):
        self.k, self.larger, self.start = k, larger, start
        self.rows, self.kth = {}, {}

    def limit(self, per) -> np.ndarray:
        return self.kth.get(per, self.start)

    def add(self, per, qpos, ids, d) -> None:
        if not len(qpos):
            return
        if per in self.rows:
            qpos, ids, d = (np.concatenate(x) for x in zip(self.rows[per], (qpos, ids, d), strict=True))
        else:
            self.kth[per] = self.start.copy()
        order = np.lexsort((ids, -d if self.larger else d, qpos))
        qpos, ids, d = qpos[order], ids[order], d[order]
        ranks = _ranks_of(qpos)
        last = ranks == self.k
        self.kth[per][qpos[last]] = d[last]
        kept = ranks <= self.k
        self.rows[per] = qpos[kept], ids[kept], d[kept]

    def results(self):
        """``(per-key values, query positions, ids, distances, ranks)`` of each per-key group."""
        for per, (qpos, ids, d) in self.rows.items():
            yield per, qpos, ids, d, _ranks_of(qpos)


def _searched(pieces, qs, search, metric, k, radius, join_keys, per_keys, kinds, larger):
    """Hits of the queries ``qs`` among item batches: the best ``k`` once all have passed, hits within the radius as found."""
    groups = {}
    for kv, rows in kernels.group_rows(qs["keys"]):
        rows = np.arange(len(qs["ids"]))[rows]
        whole = len(rows) == len(qs["ids"])
        groups[kv] = (rows, qs["vecs"] if whole and not qs["keys"] else np.ascontiguousarray(qs["vecs"][rows]))
    limits = np.full(len(qs["ids"]), -np.inf if larger else np.inf) if qs.get("limits") is None else qs["limits"]
    best = {kv: _Best(limits[rows], k, larger) for kv, (rows, _) in groups.items()} if k is not None else {}

    def emitted(per, qpos, ids, d, ranks):
        values = [np.full(len(qpos), x, np.int64) for x in per]
        return _labelled(_batch(values, qs["ids"][qpos], ids, d, ranks, per_keys, kinds), qs["labels"], qpos)

    for rb in pieces:
        if not rb.num_rows:
            continue
        opened = search.open(rb)
        ids = rb.column("_id").to_numpy(zero_copy_only=False).astype(np.int64)
        jcols = [rb.column(kk).to_numpy(zero_copy_only=False).astype(np.int64) for kk in join_keys]
        pcols = [rb.column(kk).to_numpy(zero_copy_only=False).astype(np.int64) for kk in per_keys]
        for kv, irows in kernels.group_rows(jcols):
            got = groups.get(kv)
            if got is None:
                continue
            qrows, qm = got
            irows = np.arange(rb.num_rows)[irows]
            for pv, prow in kernels.group_rows([p[irows] for p in pcols]):
                sel = irows[prow] if per_keys else irows
                prepared, own = search.prepare(opened, sel, metric), ids[sel]
                # queries are taken in steps, so hits of a radius search leave the task as they are found
                step = max(1, REDUCE_AT // (len(sel) if k is None else k))
                for at in range(0, len(qm), step):
                    limit = None if k is None else best[kv].limit(pv)[at:at + step]
                    qi, vi, d = search.search(qm[at:at + step], prepared, own, kv, metric, k, radius, limit=limit)
                    if k is None:
                        if len(qi):
                            yield emitted(pv, qrows[at + qi], own[vi], d, np.zeros(len(qi), np.int32))
                        continue
                    near = d >= limit[qi] if larger else d <= limit[qi]
                    best[kv].add(pv, at + qi[near], own[vi[near]], d[near])
    for kv, found in best.items():
        for pv, qpos, *hits in found.results():
            yield emitted(pv, groups[kv][0][qpos], *hits)


def _broadcast_queries(queries, items, dim, metric, k, radius, join_keys, per_keys, kinds, schema, larger,
                       collected=None, item_transform=None, item_search=None, item_groups=None, limits=None, arrays=False):
    spark = queries.sparkSession
    side = _collect_side(queries, join_keys, "_qid", "_qv", dim, collected)
    if limits is not None:
        place = np.minimum(np.searchsorted(limits[0], side["ids"]), max(0, len(limits[0]) - 1))
        known = limits[0][place] == side["ids"] if len(limits[0]) else np.zeros(len(side["ids"]), bool)
        side["limits"] = np.where(known, limits[1][place], -np.inf if larger else np.inf) if len(limits[0]) else None
    bc = spark.sparkContext.broadcast(side)
    schema = T.StructType(schema.fields + [queries.schema[c] for c in _labels(queries)])
    item_columns = _item_keys(join_keys, per_keys)[0]
    search = VectorSearch(dim) if item_search is None else item_search
    stored = [c for c in search.columns if c not in item_columns]

    def run(batches):
        yield from _searched(_pieces(batches, radius), bc.value, search, metric, k, radius, join_keys, per_keys, kinds, larger)

    scan = scan_filter(items, join_keys, side["keys"], item_groups)
    if item_search is None and item_transform is not None:
        scan = item_transform(scan)
    return _mapped(scan.select(*item_columns, "_id", *stored), run, schema, arrays)


def _tile_counts(ni, nq, item_rows: int, query_rows: int, share):
    """``(item slices, query tiles)`` of a group of ``ni`` items and ``nq`` queries: as many as their sizes need, and
    both the more where a tile would be over ``share`` pairs.  Columns."""
    ni, nq = F.greatest(ni.cast("double"), F.lit(1.0)), F.greatest(nq.cast("double"), F.lit(1.0))
    si, sq = F.ceil(ni / item_rows), F.ceil(nq / query_rows)
    more = F.sqrt(F.greatest(F.lit(1.0), ni * nq / F.lit(float(share)) / (si * sq)))
    return F.least(ni, F.ceil(si * more)).cast("int"), F.least(nq, F.ceil(sq * more)).cast("int")


def _tiled(queries, items, dim, metric, k, radius, join_keys, per_keys, kinds, schema, larger, item_search=None, hits=0,
           arrays=False):
    spark = queries.sparkSession
    item_rows, query_rows = tile_rows(spark, dim), tile_rows(spark, dim, hits)
    search = VectorSearch(dim) if item_search is None else item_search
    item_columns = _item_keys(join_keys, per_keys)[0]
    stored = [c for c in search.columns if c not in item_columns]
    items = items.select(*[F.col(c).alias(c) for c in [*item_columns, "_id", *stored]])
    tasks = 2 * spark.sparkContext.defaultParallelism
    if join_keys:
        # Written once: the queries (an IVF probe, say) are counted, split and joined.
        checkpoint_dir(spark)
        queries = queries.checkpoint(eager=True)
        queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])
        ic = items.groupBy(*join_keys).agg(F.count(F.lit(1)).alias("_ni"))
        qc = queries.groupBy(*join_keys).agg(F.count(F.lit(1)).alias("_nq"))
        sizes = ic.join(qc, join_keys).checkpoint(eager=True)
        work = sizes.agg(F.sum(F.col("_ni").cast("double") * F.col("_nq"))).first()[0] or 0
        si, sq = _tile_counts(F.col("_ni"), F.col("_nq"), item_rows, query_rows, max(work / tasks, TILE_PAIRS))
        # One row per asked group, no more than query rows; broadcast where its counted size allows, so that
        # a hot group's rows are cut into tiles before their first shuffle.
        splits = sizes.select(*join_keys, si.alias("_si"), sq.alias("_sq"))
        groups, tiles = splits.agg(F.count(F.lit(1)), F.sum(F.col("_si").cast("long") * F.col("_sq"))).first()
        if 40 * groups <= broadcast_budget(spark):
            splits = F.broadcast(splits)
        it = items.join(splits, join_keys)
        qt = queries.join(splits, join_keys)
    else:
        ni, nq = items.count(), queries.count()
        si, sq = _tile_counts(F.lit(ni), F.lit(nq), item_rows, query_rows, max(ni * nq / tasks, TILE_PAIRS))
        si, sq = spark.range(1).select(si, sq).first()
        tiles = si * sq
        it = items.withColumn("_si", F.lit(si)).withColumn("_sq", F.lit(sq))
        qt = queries.withColumn("_si", F.lit(si)).withColumn("_sq", F.lit(sq))
    # Queries and items of a tile in one table, queries first; a column that is not a row's own is null.
    labels = _labels(queries)
    it = (it.withColumn("_ps", F.pmod(F.xxhash64("_id"), F.col("_si")).cast("int"))
            .withColumn("_qs", F.explode(F.sequence(F.lit(0), F.col("_sq") - 1))).withColumn("_item", F.lit(1)))
    qt = (qt.withColumn("_qs", F.pmod(F.xxhash64("_qid"), F.col("_sq")).cast("int"))
            .withColumn("_ps", F.explode(F.sequence(F.lit(0), F.col("_si") - 1))).withColumn("_item", F.lit(0)))
    kinds_of = {f.name: f.dataType for f in [*queries.select("_qid", "_qv", *labels).schema.fields, *items.schema.fields]}
    columns = [*item_columns, "_qs", "_ps", "_item", "_qid", "_qv", *labels, "_id", *stored]

    def with_all(rows, own):
        return rows.select(*[(F.col(c) if c in own else F.lit(None)).cast(kinds_of[c]).alias(c) if c in kinds_of else F.col(c)
                             for c in columns])

    rows = with_all(it, [*item_columns, "_id", *stored]).unionAll(with_all(qt, [*join_keys, "_qid", "_qv", *labels]))
    place = [*join_keys, "_qs", "_ps"]
    if join_keys:
        rows = rows.repartition(max(1, min(4096, 3 * (tiles or 0))), *place)
    else:
        rows = rows.repartitionById(tiles, (F.col("_qs") * F.lit(si) + F.col("_ps")).cast("int"))
    rows = rows.sortWithinPartitions(*place, "_item")
    stats = None
    if spark.conf.get("vecspark.tile.stats", "false").lower() == "true":
        stats = spark.sparkContext.accumulator((0, 0, 0), _TileStats())
        LAST_TILE_STATS["acc"] = stats

    def runs(batches):
        """``(tile, whether items, rows)`` of each stretch of a batch."""
        for rb in batches:
            if not rb.num_rows:
                continue
            at = np.stack([rb.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in [*place, "_item"]], axis=1)
            first = np.r_[0, np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1, rb.num_rows]
            for a, b in itertools.pairwise(first.tolist()):
                yield tuple(at[a, :-1].tolist()), bool(at[a, -1]), rb.slice(a, b - a)

    def run(batches):
        for _, parts in itertools.groupby(runs(batches), key=lambda r: r[0]):
            asked, passing = [], iter(())
            for _, is_item, rb in parts:
                if is_item:
                    passing = itertools.chain([rb], (r[2] for r in parts))
                    break
                asked.append(rb.select([*join_keys, "_qid", "_qv", *labels]))
            if not asked:
                continue  # groupby passes over the rest
            side = _collect_side(None, join_keys, "_qid", "_qv", dim, pa.Table.from_batches(asked))
            asked, seen = None, []

            def counted(rbs, seen=seen):
                for rb in rbs:
                    seen.append(rb.num_rows)
                    yield rb

            yield from _searched(_pieces(counted(passing), radius), side, search, metric, k, radius, join_keys, per_keys, kinds, larger)
            if stats is not None and seen:
                stats.add((1, sum(seen), len(side["ids"])))

    schema = T.StructType(schema.fields + [queries.schema[c] for c in labels])
    return _mapped(rows, run, schema, arrays)


class _TileStats(AccumulatorParam):
    """(tiles, largest item tile, largest query tile) over the tasks of a tiled plan."""

    def zero(self, value):
        return (0, 0, 0)

    def addInPlace(self, a, b):
        return (a[0] + b[0], max(a[1], b[1]), max(a[2], b[2]))


LAST_TILE_STATS = {}


def last_tile_stats() -> tuple[int, int, int] | None:
    """``(tiles, max item rows, max query rows)`` of the last tiled plan run with
    ``vecspark.tile.stats=true`` (an accumulator; valid after the job ran)."""
    acc = LAST_TILE_STATS.get("acc")
    return None if acc is None else acc.value


def _item_keys(join_keys, per_keys):
    """Item key columns without repeats, and the positions of join and per keys in it."""
    keys = list(join_keys) + [p for p in per_keys if p not in join_keys]
    return keys, [keys.index(j) for j in join_keys], [keys.index(p) for p in per_keys]
