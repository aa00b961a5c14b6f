"""k-nearest-neighbour and radius search over an index.

Long form (one row per hit) is the primary result:
``query_idx, vector_idx, distance, ranking`` (+ ``shard_id`` for per-shard
results).  The array form of the reference (one row per query:
``query_vector, query_idx, vector_idxs, distances``) is built from it.

Plans by index kind:

flat      every query against every stored vector (``nearest``).
ivf_*     probe: the ``nprobe`` nearest lists of each shard per query (a
          ``nearest`` against the centroids); then ``nearest`` against the
          postings of those lists only, joined on ``(shard_id, list_id)``.
ivf_pq    as ivf, against the reconstructions of the stored codes.

``scope="global"`` ranks over all shards (the sharded search followed by the
merge); ``scope="shard"`` keeps each shard's own top k.  ``where`` filters
the stored vectors on tag columns before any distance is computed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions.distance import distance
from vecspark.model import VectorIndex, checked_vector, positive_int
from vecspark.operators import nearest as nn
from vecspark.operators import pq
from vecspark.operators.packing import unpack_vectors
from vecspark.plans import probing
from vecspark.plans.index import index_keys, shards_of_key
from vecspark.session import checkpoint_dir


def prepare_queries(queries: DataFrame, dim: int, id_col: str | None = "id",
                    vector_col: str = "vector", stable: bool = True, keep=()) -> DataFrame:
    """(_qid, _qv, _qlab, query_vector): validated queries with a row identity.

    Each query row gets its own result list; its id is only a label
    (``_qlab``), so ids may repeat.  Without ids the label is NULL, as in the
    reference.  ``_qid`` is ``monotonically_increasing_id()``; with ``stable``
    the rows are written once, so it stays fixed over several uses (the plans
    that use the queries once do not need that).  ``keep`` columns are carried along.
    """
    if id_col is None:
        label = F.lit(None).cast(T.LongType())
    else:
        c = F.col(id_col).cast("long")
        label = F.when(c.isNull(), F.raise_error(F.lit("query ids must not be NULL"))).otherwise(c)
    out = queries.select(F.monotonically_increasing_id().alias("_qid"),
                         checked_vector(vector_col, dim, "query vector").alias("_qv"), label.alias("_qlab"),
                         F.col(vector_col).cast(T.ArrayType(T.FloatType())).alias("query_vector"), *keep)
    if stable:
        checkpoint_dir(queries.sparkSession)
        out = out.checkpoint(eager=True)
    return out


def _used_twice(index: VectorIndex) -> bool:
    """Whether a long-form search joins back to the queries (re-ranking, or a probe beyond the broadcast budget)."""
    spec = index.spec
    rows = index.extra.get("groups", 1) * spec.nlist
    return index.options.rerank is not None or (
        spec.kind != "flat" and nn.side_bytes(rows, spec.dim) > nn.broadcast_budget(index.spark))


def _keyed(df: DataFrame, shards: list[int] | None) -> DataFrame:
    """Restrict to the shards a key names; a literal list reaches the scan as a partition filter."""
    return df if shards is None else df.where(F.col("shard_id").isin(shards))


def candidates(index: VectorIndex, q: DataFrame, *, k: int | None = None, radius: float | None = None,
               scope: str = "global", where: Column | None = None, index_key: str | None = None,
               nprobe: int | None = None, strategy: str = "auto", final: bool = True, fill: bool = False,
               exact: bool = False, limits=None, arrays: bool = False) -> DataFrame:
    """Ranked hits ``[shard_id,] _qid, _id, _d, _rank`` for prepared queries.

    ``final=False`` (radius search) skips the per-query ranking window; the
    hits are complete but ``_rank`` is only task-local.  Queries with a
    ``shard_id`` column meet that shard alone.  ``fill`` and ``exact`` choose the
    lists probed (see ``knn`` and ``range_search``), ``limits`` and ``arrays`` go to ``nearest``.
    """
    if scope not in ("global", "shard"):
        raise ValueError("scope must be 'global' or 'shard'")
    spec = index.spec
    per_keys = ["shard_id"] if scope == "shard" else []
    post = index.postings
    if where is not None:
        post = post.where(where)
    shards = None if index_key is None else shards_of_key(index, index_key)
    post = _keyed(post, shards)
    own = ["shard_id"] if "shard_id" in q.columns else []
    qs = q.select(*own, "_qid", "_qv", *([] if arrays else ["_qlab"]))
    groups = index.extra.get("groups", 1)
    if spec.kind == "flat" or (exact and not probing.lists_fit(index, groups)):  # beyond the budget every list is searched
        items = post.select("shard_id", F.col("id").alias("_id"), F.col("vector").alias("_v"))
        return nn.nearest(qs, items, dim=spec.dim, metric=spec.metric, k=k, radius=radius, join_keys=own,
                          per_keys=per_keys, queries_unique=not own, strategy=strategy, final=final, shards=groups, limits=limits,
                          arrays=arrays)
    if not index.trained or index.centroids is None:
        raise ValueError(f"an index of kind {spec.kind!r} must be trained before it is searched")
    nprobe = positive_int("nprobe", index.options.nprobe if nprobe is None else nprobe)
    cents = _keyed(index.centroids, shards)
    asked = q.count()
    if fill or exact:
        chosen = probing.shell_probe(index, qs, cents, radius) if exact else probing.filled_probe(
            index, qs, cents, post, k, nprobe, groups)
        return nn.nearest(chosen, post.select("shard_id", "list_id", F.col("id").alias("_id"), F.col("vector").alias("_v")),
                          dim=spec.dim, metric=spec.metric, k=k, radius=radius, join_keys=["shard_id", "list_id"],
                          per_keys=per_keys, queries_unique=False, strategy=strategy, final=final, shards=groups,
                          queries_bound=asked * groups * spec.nlist, item_groups=groups * spec.nlist)
    probe = nn.nearest(qs, cents.select("shard_id", F.col("list_id").cast("long").alias("_id"), F.col("centroid").alias("_v")),
                       dim=spec.dim, metric=spec.metric, k=min(nprobe, spec.nlist), join_keys=own, per_keys=["shard_id"],
                       queries_unique=not own, items_rows=groups * spec.nlist, carry_query_vector=True,
                       items_table=_centroid_table(index, groups, shards))
    # The probe is as many rows as asked for, so it need not be counted; nor is a list looked for that no query probes.
    bound, known = asked * min(nprobe, spec.nlist) * groups, groups * spec.nlist
    qp = probe.select("shard_id", F.col("_id").cast("int").alias("list_id"), "_qid", *([] if arrays else ["_qlab"]),
                      *(["_qv"] if "_qv" in probe.columns else []))
    if "_qv" not in qp.columns:  # centroids beyond the broadcast budget: attach vectors by id
        qp = qp.join(qs.select("_qid", "_qv"), "_qid")
    decode = coded = None
    if spec.kind == "ivf_pq":
        items = post.select("shard_id", "list_id", F.col("id").alias("_id"), "code")

        def decode(rows: DataFrame) -> DataFrame:
            return pq.decode(rows, index.centroids, index.codebooks, dim=spec.dim, m=spec.m, dsub=spec.dsub,
                             ks=spec.ks, rows_hint=groups * (spec.nlist + spec.m * spec.ks))

        coded = pq.code_search(index.spark, index.centroids, index.codebooks, dim=spec.dim, m=spec.m, dsub=spec.dsub, ks=spec.ks,
                               rows_hint=groups * (spec.nlist + spec.m * spec.ks), memo=index.extra.get("memo"))
        rerank = index.options.rerank
        if rerank is not None:
            if not spec.refine:
                raise ValueError("rerank needs an ivf_pq index built with refine=True (raw vectors kept)")
            if k is None:
                raise ValueError("rerank does not apply to radius search on an ivf_pq index; unset the option "
                                 "(hits are judged by the reconstructions)")
            return _reranked(qp, qs, items, decode, coded, post, spec, k, max(rerank, k), per_keys, strategy, groups, bound, known)
    else:
        items = post.select("shard_id", "list_id", F.col("id").alias("_id"), F.col("vector").alias("_v"))
    return nn.nearest(qp, items, dim=spec.dim, metric=spec.metric, k=k, radius=radius,
                      join_keys=["shard_id", "list_id"], per_keys=per_keys, queries_unique=False,
                      strategy=strategy, final=final, item_transform=decode, item_search=coded, shards=groups,
                      queries_bound=bound, item_groups=known, limits=limits, arrays=arrays)


def _centroid_table(index: VectorIndex, groups: int, shards: list[int] | None):
    """The list centroids of an opened index, collected once (they are broadcast by every probe); None beyond the budget."""
    memo = index.extra.get("memo")
    if memo is None or shards is not None or nn.side_bytes(groups * index.spec.nlist, index.dim) > nn.broadcast_budget(index.spark):
        return None
    if "centroids" not in memo:
        memo["centroids"] = index.centroids.select("shard_id", F.col("list_id").cast("long").alias("_id"),
                                                   F.col("centroid").alias("_v")).toArrow()
    return memo["centroids"]


def _reranked(qp, qs, items, decode, coded, post, spec, k, rerank, per_keys, strategy, groups, bound, known) -> DataFrame:
    """PQ top-``rerank`` per (query, shard), re-scored with the raw vectors, then the top k.

    Candidates (at most ``rerank`` per query and shard) are stored once and
    counted.  Where they fit the broadcast budget, the raw vectors of their
    value ranges are scanned in place and meet them in a broadcast join; else
    both sides are joined on the stored vector's id, which no hot list can
    skew.  A stored id that repeats is one candidate, scored by each of its
    rows; the nearest counts.
    """
    approx = nn.nearest(qp, items, dim=spec.dim, metric=spec.metric, k=rerank, join_keys=["shard_id", "list_id"],
                        per_keys=["shard_id"], queries_unique=False, strategy=strategy, item_transform=decode,
                        item_search=coded, shards=groups, queries_bound=bound, item_groups=known)
    cands = approx.select("shard_id", "_qid", "_qlab", "_id").distinct()
    checkpoint_dir(cands.sparkSession)
    cands = cands.checkpoint(eager=True)
    raw = post.select("shard_id", F.col("id").alias("_id"), F.col("vector").alias("_raw"))
    near = cands.join(qs.select("_qid", "_qv"), "_qid")
    if nn.side_bytes(cands.count(), spec.dim) <= nn.broadcast_budget(cands.sparkSession):
        ids = cands.agg(F.min("shard_id"), F.max("shard_id"), F.min("_id"), F.max("_id")).first()
        if ids[0] is not None:
            raw = raw.where(F.col("shard_id").between(ids[0], ids[1]) & F.col("_id").between(ids[2], ids[3]))
        near = F.broadcast(near)
    exact = (raw.join(near, ["shard_id", "_id"])
             .select("shard_id", "_qid", "_qlab", "_id", distance("_qv", "_raw", spec.metric).alias("_d"))
             .groupBy("shard_id", "_qid", "_qlab", "_id")
             .agg((F.max("_d") if spec.metric == "ip" else F.min("_d")).alias("_d")))
    return nn.rank_final(exact, k, per_keys, spec.metric == "ip")


def _long(hits: DataFrame, scope: str, ranked: bool = True) -> DataFrame:
    """Long form; the query's label comes with its hits, so no join back to the queries.

    Radius results carry no ranking: ranking all hits of one query would put
    them in one task, and the hit count of a query is not bounded.
    """
    shard = ["shard_id"] if scope == "shard" else []
    rank = [F.col("_rank").cast("long").alias("ranking")] if ranked else []
    return hits.select(F.col("_qlab").alias("query_idx"), *shard, F.col("_id").alias("vector_idx"),
                       F.col("_d").alias("distance"), *rank)


def _asked(index: VectorIndex, queries: DataFrame, id_col, vector_col, key_col, stable: bool) -> DataFrame:
    """Prepared queries; with ``key_col``, one row for each shard that the row's key names (V17)."""
    if key_col is None:
        return prepare_queries(queries, index.dim, id_col, vector_col, stable=stable)
    q = prepare_queries(queries, index.dim, id_col, vector_col, stable=stable, keep=[F.col(key_col).alias("_key")])
    keys = index_keys(index).select(F.col("index_key").alias("_key"), "shard_id")
    return q.join(keys, "_key").drop("_key")


def knn(index: VectorIndex, queries: DataFrame, k: int, *, id_col: str | None = "id",
        vector_col: str = "vector", scope: str = "global", where: Column | None = None,
        index_key: str | None = None, key_col: str | None = None, nprobe: int | None = None, fill: bool = False,
        waves: bool = False, strategy: str = "auto") -> DataFrame:
    """The k nearest stored vectors of each query, long form (V11-V13, V18, V20, V21).

    ``index_key`` names one shard for all queries, ``key_col`` a column with
    each query's own key; a query whose key is unknown has no hits.  ``fill``
    (``ivf_flat``) probes as many more lists, nearest first, as hold k vectors
    that pass ``where``, so each query has k hits wherever k exist.  ``waves``
    (global scope) searches some shards first and hands their k-th distances
    to the tasks of the others, which send on nothing farther; the result
    is the same.
    """
    k = positive_int("k", k)
    if fill and (index.spec.kind != "ivf_flat" or index_key is not None or key_col is not None):
        raise ValueError("fill applies to searches of all shards of an ivf_flat index")
    q = _asked(index, queries, id_col, vector_col, key_col, _used_twice(index) or waves or fill)
    if waves:
        if scope != "global" or index.options.rerank is not None:
            raise ValueError("waves applies to global searches without re-ranking")
        hits = _in_waves(index, q, k, where, index_key, nprobe, strategy)
    else:
        hits = candidates(index, q, k=k, scope=scope, where=where, index_key=index_key, nprobe=nprobe, strategy=strategy,
                          fill=fill)
    return _long(hits, scope)


FIRST_WAVE = 4  # a quarter of the rows


def _in_waves(index: VectorIndex, q: DataFrame, k: int, where, index_key, nprobe, strategy) -> DataFrame:
    """Top k over all shards in two waves of shards.

    The first holds about a quarter of the rows.  Its result, at most k rows a
    query, is stored; its k-th distances are broadcast where they fit the
    budget (else the second wave runs without them).
    """
    sizes = index.postings.groupBy("shard_id").count().orderBy("shard_id").collect() if index.extra.get("groups", 1) > 1 or index.sharded else []
    total, first, held = sum(r["count"] for r in sizes), [], 0
    for r in sizes:
        if held * FIRST_WAVE < total:
            first.append(r["shard_id"])
            held += r["count"]
    early = index.replace(postings=index.postings.where(F.col("shard_id").isin(first)))
    late = index.replace(postings=index.postings.where(~F.col("shard_id").isin(first)))
    if not first or len(first) == len(sizes):
        return candidates(index, q, k=k, where=where, index_key=index_key, nprobe=nprobe, strategy=strategy)
    checkpoint_dir(index.spark)
    got = candidates(early, q, k=k, where=where, index_key=index_key, nprobe=nprobe, strategy=strategy).checkpoint(eager=True)
    limits = None
    if 16 * q.count() <= nn.broadcast_budget(index.spark):
        kth = got.where(F.col("_rank") == k).select("_qid", "_d").toArrow()
        ids, d = kth.column("_qid").to_numpy(), kth.column("_d").to_numpy()
        order = ids.argsort()
        limits = ids[order], d[order]
    rest = candidates(late, q, k=k, where=where, index_key=index_key, nprobe=nprobe, strategy=strategy, final=False, limits=limits)
    columns = ["_qid", "_qlab", "_id", "_d"]
    return nn.rank_final(got.select(*columns).unionByName(rest.select(*columns)), k, [], index.metric == "ip")


def range_search(index: VectorIndex, queries: DataFrame, radius: float, *, id_col: str | None = "id",
                 vector_col: str = "vector", scope: str = "global", where: Column | None = None,
                 index_key: str | None = None, key_col: str | None = None, nprobe: int | None = None, exact: bool = False,
                 strategy: str = "auto") -> DataFrame:
    """Every stored vector nearer than ``radius`` (``>`` radius for inner product), long form (V15, V16).

    ``exact`` (``ivf_flat``, not inner product) probes every list whose shell,
    the span of its vectors' distances from its centroid, the ball around the
    query can meet: all hits, as in a flat search, without reading the other lists.
    """
    if radius is None:
        raise ValueError("radius is required")
    if exact and (index.spec.kind != "ivf_flat" or index.metric == "ip" or index_key is not None or key_col is not None):
        raise ValueError("exact applies to searches of all shards of an ivf_flat index, for metrics with a triangle inequality")
    q = _asked(index, queries, id_col, vector_col, key_col, _used_twice(index) or exact)
    hits = candidates(index, q, radius=float(radius), scope=scope, where=where, index_key=index_key,
                      nprobe=nprobe, strategy=strategy, final=False, exact=exact)
    return _long(hits, scope, ranked=False)


def to_array_form(hits: DataFrame, q: DataFrame, *, preserve_vector: bool | None = True,
                  ranked: bool = True, larger_is_nearer: bool = False) -> DataFrame:
    """One row per query (V14): ``query_vector, query_idx, vector_idxs, distances``.

    Queries without hits keep their row with empty arrays.  ``query_vector``
    is NULL unless ``preserve_vector`` is true.  Hits are in ranking order
    (k-NN) or by (distance, id) (radius search; descending for inner product).
    A radius row holds every hit of its query, as the reference's result
    type does; at scale prefer the long form.
    """
    order = F.struct((-F.col("_d") if larger_is_nearer else F.col("_d")).alias("d"), F.col("_id").alias("i"))
    agg = hits.groupBy("_qid").agg(F.array_sort(F.collect_list(F.struct(
        (F.col("_rank") if ranked else F.lit(0)).alias("_r"), order.alias("_o"), "_id", "_d"))).alias("_h"))
    out = q.join(agg, "_qid", "left")
    keep = bool(preserve_vector)
    return out.select(
        (F.col("query_vector") if keep else F.lit(None).cast(T.ArrayType(T.FloatType()))).alias("query_vector"),
        F.col("_qlab").alias("query_idx"),
        F.coalesce(F.transform("_h", lambda x: x["_id"]), F.array().cast(T.ArrayType(T.LongType())))
        .alias("vector_idxs"),
        F.coalesce(F.transform("_h", lambda x: x["_d"].cast("float")), F.array().cast(T.ArrayType(T.FloatType())))
        .alias("distances"))


def from_array_form(results: DataFrame, *, idxs_col: str = "vector_idxs", distances_col: str = "distances",
                    keep=("query_idx",)) -> DataFrame:
    """Array-form rows back to one row per hit with its ordinality (``ranking`` from 1).

    The parallel unnest of the reference's result arrays; arrays of unequal
    length are an error.  Rows with empty arrays give no hit rows.
    """
    keep = list(keep)
    i, d = F.col(idxs_col), F.col(distances_col)
    zipped = F.when(F.size(i) != F.size(d), F.raise_error(F.lit("result arrays differ in length"))) \
        .otherwise(F.arrays_zip(i.alias("vector_idx"), d.alias("distance")))
    return results.select(*keep, F.posexplode(zipped).alias("_p", "_h")).select(
        *keep, F.col("_h.vector_idx").alias("vector_idx"), F.col("_h.distance").alias("distance"),
        (F.col("_p") + 1).cast("long").alias("ranking"))


def search(index: VectorIndex, queries: DataFrame, k: int, *, id_col: str | None = "id",
           vector_col: str = "vector", preserve_vector: bool | None = True, index_key: str | None = None,
           where: Column | None = None, nprobe: int | None = None, strategy: str = "auto") -> DataFrame:
    """Array-form k-nearest-neighbour search, the reference's search result shape."""
    k = positive_int("k", k)
    q = prepare_queries(queries, index.dim, id_col, vector_col)
    hits = candidates(index, q, k=k, where=where, index_key=index_key, nprobe=nprobe, strategy=strategy)
    return to_array_form(hits, q, preserve_vector=preserve_vector)


def range_search_arrays(index: VectorIndex, queries: DataFrame, radius: float, *, id_col: str | None = "id",
                        vector_col: str = "vector", preserve_vector: bool | None = True,
                        index_key: str | None = None, where: Column | None = None, nprobe: int | None = None,
                        strategy: str = "auto") -> DataFrame:
    """Array-form radius search; tasks hand on hits as arrays, which are never rows of their own."""
    q = prepare_queries(queries, index.dim, id_col, vector_col)
    hits = candidates(index, q, radius=float(radius), where=where, index_key=index_key, nprobe=nprobe,
                      strategy=strategy, final=False, arrays=True)
    return _joined_arrays(hits, q, bool(preserve_vector), index.metric == "ip")


def _joined_arrays(hits: DataFrame, q: DataFrame, preserve_vector: bool, larger: bool) -> DataFrame:
    """``to_array_form`` of a radius search's ``_qid, _ids, _ds``: a query's row and its arrays come one after the other."""
    vector = T.ArrayType(T.FloatType())
    asked = q.select("_qid", (F.col("query_vector") if preserve_vector else F.lit(None).cast(vector)).alias("query_vector"),
                     F.col("_qlab").alias("query_idx"), *[F.lit(None).cast(nn.ARRAYS[c].dataType).alias(c) for c in ("_ids", "_ds")])
    found = hits.select("_qid", F.lit(None).cast(vector).alias("query_vector"), F.lit(None).cast("long").alias("query_idx"),
                        "_ids", "_ds")
    rows = asked.unionAll(found).repartition("_qid").sortWithinPartitions("_qid", F.col("_ids").isNotNull())
    schema = T.StructType([T.StructField("query_vector", vector), T.StructField("query_idx", T.LongType()),
                           T.StructField("vector_idxs", T.ArrayType(T.LongType()), False),
                           T.StructField("distances", vector, False)])

    def merged(held):
        table = pa.Table.from_batches(held).combine_chunks()
        first = table.column("_ids").is_null().to_numpy(zero_copy_only=False)  # a query's own row
        sizes = pc.fill_null(pc.list_value_length(table.column("_ids")), 0).to_numpy().astype(np.int64)
        ids, d = (pc.list_flatten(table.column(c)).to_numpy() for c in ("_ids", "_ds"))
        of = np.repeat(np.cumsum(first) - 1, sizes)
        order = np.lexsort((ids, -d if larger else d, of))
        ends = pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=int(first.sum())))], type=pa.int32())
        own = table.filter(pa.array(first)).select(["query_vector", "query_idx"]).combine_chunks()
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (ids[order], d[order].astype(np.float32))]
        return pa.RecordBatch.from_arrays([*(c.combine_chunks() for c in own.columns), *lists], names=schema.names)

    def run(batches):
        held = []
        for rb in batches:
            starts = np.flatnonzero(rb.column("_ids").is_null().to_numpy(zero_copy_only=False))
            if not len(starts):  # more of the query before
                held.append(rb)
                continue
            last = int(starts[-1])
            if held or last:
                yield merged([*held, rb.slice(0, last)])
            held = [rb.slice(last)]
        if held:
            yield merged(held)

    return rows.mapInArrow(run, schema)


def search_packed(index: VectorIndex, packed: DataFrame, k: int, *, vectors_col: str = "vectors",
                  ids_col: str | None = "ids", preserve_vector: bool | None = True, index_key: str | None = None,
                  where: Column | None = None, nprobe: int | None = None) -> DataFrame:
    """Array-form k-NN for packed queries (a flat vector array per row, ids alongside or none).

    The packed rows are unpacked (bounded by the packing's page size), then
    searched like any query table; without ids, ``query_idx`` is NULL.
    """
    rows = unpack_vectors(packed, index.dim, ids_col=ids_col, vectors_col=vectors_col)
    return search(index, rows, k, id_col="id" if ids_col else None, preserve_vector=preserve_vector,
                  index_key=index_key, where=where, nprobe=nprobe)


def range_search_packed(index: VectorIndex, packed: DataFrame, radius: float, *, vectors_col: str = "vectors",
                        ids_col: str | None = "ids", preserve_vector: bool | None = True,
                        index_key: str | None = None, where: Column | None = None,
                        nprobe: int | None = None) -> DataFrame:
    """Array-form radius search for packed queries."""
    rows = unpack_vectors(packed, index.dim, ids_col=ids_col, vectors_col=vectors_col)
    return range_search_arrays(index, rows, radius, id_col="id" if ids_col else None,
                               preserve_vector=preserve_vector, index_key=index_key, where=where, nprobe=nprobe)
