"""

``entry(spark)`` runs the flagship query (exact 10-NN of every embedding)
each over the whole ``embeddings`` table of ``sf_dir``: every stored vector
is also a query, so the work grows with the table.  ``oracle_sql()`` gives
the same result as DuckDB SQL over the same Parquet files (brute force
cross joins and Lloyd iterations unrolled as CTEs).  The queries of the
``llm`` subpackage and the pipeline are added where these exist.

Distances are emitted as DOUBLE rounded to 6 decimals in long form;
array-form distances keep the reference's REAL type on both sides.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

_ROOT = os.path.dirname(os.path.abspath(__file__))
if _ROOT not in sys.path:  # the driver may load this file by path
    sys.path.insert(0, _ROOT)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import vecspark as vs  # noqa: E402
from vecspark.session import checkpoint_dir  # noqa: E402
from vecspark.sources.tables import embeddings, ramp  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the registered queries.
K = 10
RADIUS = 1.3
RADIUS_IP = 0.4  # inner product: hits are the pairs with similarity above it
NLIST = 8
ITERS = 3
NPROBE = 2
SHARDS = 4
PAGE = 256
PQ_NLIST, PQ_M, PQ_KS, PQ_ITERS = 4, 8, 16, 2
RERANK = 20
DIM = 64


def _emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings(spark, sf_dir)


def _long(df: DataFrame) -> DataFrame:
    return df.withColumn("distance", F.round("distance", 6))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: exact 10 nearest neighbours of every embedding (sf0.001)."""
    return knn_flat_l2(spark, SMOKE_DIR)


# ---------------------------------------------------------------- Spark side

def pack_by_label(spark, sf_dir):
    return vs.pack_vectors(_emb(spark, sf_dir), by=["label"], page_size=PAGE)


def unpack_vectors(spark, sf_dir):
    packed = vs.pack_vectors(_emb(spark, sf_dir), by=["label"], page_size=PAGE)
    return vs.unpack_vectors(packed, DIM)


def _flat(spark, sf_dir, metric="l2", shard=None):
    emb = _emb(spark, sf_dir)
    return emb, vs.build_index(emb, DIM, "flat", metric, shard=shard, tag_columns=["label"])


def _knn_metric(metric):
    def run(spark, sf_dir):
        emb, idx = _flat(spark, sf_dir, metric)
        return _long(vs.knn(idx, emb, K))
    return run


knn_flat_l2 = _knn_metric("l2")
knn_flat_ip = _knn_metric("ip")
knn_flat_l1 = _knn_metric("l1")
knn_flat_linf = _knn_metric("linf")


def knn_array_form(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir)
    return vs.search(idx, emb, K, preserve_vector=True)


def knn_unnest_ordinality(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir)
    return vs.from_array_form(vs.search(idx, emb, K, preserve_vector=False))


def knn_packed_queries(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir)
    packed = vs.pack_vectors(emb, page_size=PAGE)
    return vs.search_packed(idx, packed, K, preserve_vector=True)


def range_flat_l2(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir)
    return _long(vs.range_search(idx, emb, RADIUS))


def range_flat_ip(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir, "ip")
    return _long(vs.range_search(idx, emb, RADIUS_IP))


def range_array_form(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir)
    return vs.range_search_arrays(idx, emb, RADIUS, preserve_vector=False)


def knn_tagged(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir)
    return _long(vs.knn(idx, emb, K, where=F.col("label") == 3))


def sharded_local_topk(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir, shard=F.col("id") % SHARDS)
    return _long(vs.knn(idx, emb, K, scope="shard"))


def sharded_global_topk(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir, shard=F.col("id") % SHARDS)
    return _long(vs.knn(idx, emb, K, scope="global"))


def topk_merge_lists(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir, shard=F.col("id") % SHARDS)
    local = vs.knn(idx, emb, K, scope="shard")
    lists = local.groupBy("query_idx", "shard_id").agg(
        F.array_sort(F.collect_list(F.struct("ranking", "vector_idx", "distance"))).alias("_s")).select(
        "query_idx", F.transform("_s", lambda s: s["vector_idx"]).alias("idxs"),
        F.transform("_s", lambda s: s["distance"]).alias("distances"))
    merged = vs.topk_merge(lists, K, by=["query_idx"])
    return merged.withColumn("distances", F.transform("distances", lambda x: F.round(x, 6)))


def _ivf(spark, sf_dir, nlist=NLIST, shard=None, **options):
    emb = _emb(spark, sf_dir)
    return emb, vs.build_index(emb, DIM, "ivf_flat", nlist=nlist, iterations=ITERS, shard=shard, **options)


def ivf_centroids(spark, sf_dir):
    _, idx = _ivf(spark, sf_dir)
    return idx.centroids.select("list_id", F.transform("centroid", lambda x: F.round(x, 6)).alias("centroid"))


def ivf_postings(spark, sf_dir):
    _, idx = _ivf(spark, sf_dir)
    return idx.postings.select("id", "list_id")


def ivf_knn_nprobe2(spark, sf_dir):
    emb, idx = _ivf(spark, sf_dir, nprobe=NPROBE)
    return _long(vs.knn(idx, emb, K))


def ivf_knn_ip(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    idx = vs.build_index(emb, DIM, "ivf_flat", "ip", nlist=NLIST, iterations=ITERS, nprobe=NPROBE)
    return _long(vs.knn(idx, emb, K))


def ivf_range_nprobe2(spark, sf_dir):
    emb, idx = _ivf(spark, sf_dir, nprobe=NPROBE)
    return _long(vs.range_search(idx, emb, RADIUS))


def ivf_knn_all_lists(spark, sf_dir):
    emb, idx = _ivf(spark, sf_dir)
    return _long(vs.knn(idx, emb, K, nprobe=NLIST))


def ivf_sharded_build(spark, sf_dir):
    _, idx = _ivf(spark, sf_dir, nlist=4, shard=F.col("id") % SHARDS)
    return idx.postings.groupBy("shard_id", "list_id").agg(F.count(F.lit(1)).alias("n"))


def ivf_sharded_knn(spark, sf_dir):
    emb, idx = _ivf(spark, sf_dir, nlist=4, shard=F.col("id") % SHARDS, nprobe=NPROBE)
    return _long(vs.knn(idx, emb, K, scope="shard"))


def index_add_incremental(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    idx = vs.create_index(spark, DIM, "ivf_flat", nlist=NLIST, iterations=ITERS)
    idx = vs.train_index(idx, emb)
    idx = vs.add_vectors(idx, emb.where(F.col("label") < 5))
    idx = vs.add_vectors(idx, emb.where(F.col("label") >= 5))
    return idx.postings.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"))


def index_reset(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    idx = vs.add_vectors(vs.create_index(spark, DIM), emb)
    idx = vs.reset_index(idx)
    idx = vs.add_vectors(idx, emb, id_col=None, order_col="id")
    return idx.postings.select("id", "list_id", "vector")


def index_keyed_search(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir, shard=F.col("id") % 2)
    idx = vs.with_keys(idx)
    key = vs.index_keys(idx).where(F.col("shard_id") == 0).first()["index_key"]
    return _long(vs.knn(idx, emb, K, index_key=key))


def build_index_pipeline(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    idx = vs.build_index(emb, DIM, "ivf_flat", nlist=NLIST, iterations=ITERS, nprobe=NLIST)
    return _long(vs.knn(idx, emb, K))


def _pq(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    return emb, vs.build_index(emb, DIM, "ivf_pq", nlist=PQ_NLIST, m=PQ_M, ks=PQ_KS, iterations=PQ_ITERS,
                               nprobe=NPROBE)


def ivfpq_codes(spark, sf_dir):
    _, idx = _pq(spark, sf_dir)
    return idx.postings.select("id", "list_id", vs.code_array("code", PQ_M, PQ_KS).alias("code"))


def ivfpq_knn(spark, sf_dir):
    emb, idx = _pq(spark, sf_dir)
    return _long(vs.knn(idx, emb, K))


def ivfpq_rerank_knn(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    idx = vs.build_index(emb, DIM, "ivf_pq", nlist=PQ_NLIST, m=PQ_M, ks=PQ_KS, iterations=PQ_ITERS, refine=True,
                         nprobe=NPROBE, rerank=RERANK)
    return _long(vs.knn(idx, emb, K))


def _nonfinite(emb):
    """The embeddings with a NaN in vector 7 and an infinite component in vector 11."""
    first = F.when(F.col("id") == 7, F.lit(float("nan"))).when(F.col("id") == 11, F.lit(float("inf")))
    return emb.withColumn("vector", F.transform("vector", lambda x, i: F.when(
        (i == 0) & first.isNotNull(), first.cast("float")).otherwise(x)))


def knn_nonfinite_vector(spark, sf_dir):
    emb = _nonfinite(_emb(spark, sf_dir))
    return _long(vs.knn(vs.build_index(emb, DIM), emb, K))


def range_nonfinite_vector(spark, sf_dir):
    emb = _nonfinite(_emb(spark, sf_dir))
    return _long(vs.range_search(vs.build_index(emb, DIM), emb, RADIUS))


def knn_repeated_query_ids(spark, sf_dir):
    """Query ids are labels: many rows share one, each has its own list."""
    emb, idx = _flat(spark, sf_dir)
    found = vs.search(idx, emb, K, id_col="label")
    return found.withColumn("distances", F.transform("distances", lambda x: F.round(x.cast("double"), 4)))


def build_without_ids(spark, sf_dir):
    emb = _emb(spark, sf_dir)
    idx = vs.build_index(emb.withColumn("rank", -F.col("id")), DIM, "ivf_flat", nlist=NLIST, iterations=ITERS,
                         id_col=None, order_col="rank")
    return idx.postings.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def add_without_ids_sharded(spark, sf_dir):
    """Each shard's vectors are numbered from 0, also over an order column with ties (one vector per id and label)."""
    emb, shard = _emb(spark, sf_dir), F.col("id") % SHARDS
    idx = vs.add_vectors(vs.create_index(spark, DIM), emb.where("label < 5"), id_col=None, order_col="id", shard=shard)
    idx = vs.add_vectors(idx, emb.where("label >= 5"), id_col=None, order_col="id", shard=shard)
    return idx.postings.select("shard_id", "id", "vector")


def ivfpq_range(spark, sf_dir):
    emb, idx = _pq(spark, sf_dir)
    return _long(vs.range_search(idx, emb, RADIUS))


def index_keyed_range(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir, shard=F.col("id") % 2)
    idx = vs.with_keys(idx)
    key = vs.index_keys(idx).where(F.col("shard_id") == 1).first()["index_key"]
    return _long(vs.range_search(idx, emb, RADIUS, index_key=key))


def build_string_shards(spark, sf_dir):
    """A string shard key with a NULL among its values."""
    emb = _emb(spark, sf_dir)
    key = F.when(F.col("label") != 9, F.concat(F.lit("s"), (F.col("label") % 3).cast("string")))
    idx = vs.build_index(emb, DIM, shard=key)
    counts = idx.postings.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))
    return counts.join(vs.shard_labels(idx), "shard_id").select("shard", "n", "ids")


def ivf_global_merge(spark, sf_dir):
    emb, idx = _ivf(spark, sf_dir, nlist=4, shard=F.col("id") % SHARDS, nprobe=NPROBE)
    return _long(vs.knn(idx, emb, K, scope="global"))


def saved_index_search(spark, sf_dir):
    """Search of an index written to the shared scratch folder and read back."""
    _, idx = _ivf(spark, sf_dir, nprobe=NPROBE)
    path = os.path.join(checkpoint_dir(spark), f"index-{uuid.uuid4().hex}")
    vs.save_index(idx, path)
    return _long(vs.knn(vs.load_index(spark, path), _emb(spark, sf_dir), K))


def ivf_range_exact(spark, sf_dir):
    """Radius search over inverted lists that loses nothing: lists are skipped by their shells alone."""
    emb, idx = _ivf(spark, sf_dir)
    return _long(vs.range_search(idx, emb, RADIUS, exact=True))


def sharded_threshold_topk(spark, sf_dir):
    emb, idx = _flat(spark, sf_dir, shard=F.col("id") % SHARDS)
    return _long(vs.knn(idx, emb, K, waves=True))


def ivf_knn_tagged(spark, sf_dir):
    """Under a filter, a query probes on until its lists hold k matching vectors."""
    emb = _emb(spark, sf_dir)
    idx = vs.build_index(emb, DIM, "ivf_flat", nlist=NLIST, iterations=ITERS, tag_columns=["label"])
    return _long(vs.knn(idx, emb, K, where=F.col("label") == 3, fill=True))


def keyed_search_by_row(spark, sf_dir):
    """Every query row names the index it meets by that index's key."""
    emb, idx = _flat(spark, sf_dir, shard=F.col("id") % SHARDS)
    idx = vs.with_keys(idx)
    asked = emb.withColumn("shard_id", (F.col("label") % SHARDS).cast("int")).join(vs.index_keys(idx), "shard_id")
    return _long(vs.knn(idx, asked, K, key_col="index_key"))


def stored_index_append(spark, sf_dir):
    """An index stored with one half of the vectors, the other half appended as a segment of its own."""
    emb = _emb(spark, sf_dir)
    idx = vs.train_index(vs.create_index(spark, DIM, "ivf_flat", nlist=NLIST, iterations=ITERS), emb)
    path = os.path.join(checkpoint_dir(spark), f"index-{uuid.uuid4().hex}")
    vs.save_index(vs.add_vectors(vs.set_options(idx, nprobe=NPROBE), emb.where("label < 5")), path)
    vs.append_to_index(spark, path, emb.where("label >= 5"))
    return _long(vs.knn(vs.load_index(spark, path), emb, K))


def _sql_views(spark, sf_dir):
    """Names of the views of a stored index and of its queries, for SQL text."""
    emb, idx = _flat(spark, sf_dir)
    name = f"index_{uuid.uuid4().hex}"
    path = os.path.join(checkpoint_dir(spark), name)
    vs.save_index(idx, path)
    vs.register_sql(spark)
    vs.register_index(vs.load_index(spark, path), name)
    emb.createOrReplaceTempView(f"{name}_asked")
    return name, f"{name}_asked"


def sql_knn(spark, sf_dir):
    """Search of a stored index by SQL text alone."""
    items, asked = _sql_views(spark, sf_dir)
    return _long(spark.sql(vs.knn_sql(items, asked, K)))


def sql_knn_tagged(spark, sf_dir):
    items, asked = _sql_views(spark, sf_dir)
    return _long(spark.sql(vs.knn_sql(items, asked, K, where="label = 3")))


def sql_range(spark, sf_dir):
    items, asked = _sql_views(spark, sf_dir)
    return _long(spark.sql(vs.range_sql(items, asked, RADIUS)))


def series_arrays(spark, sf_dir):
    """A series of numbers from each row's id, gathered into an array."""
    return _emb(spark, sf_dir).select("id", ramp("id").alias("vector"))


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the ``llm`` subpackage and of the pipeline, where they exist."""
    found, sql = {}, {}
    try:
        from vecspark.llm.queries import ORACLES, QUERIES
    except ImportError:
        return found, sql
    found, sql = dict(QUERIES), dict(ORACLES)
    try:
        import corpus_pipeline
    except ImportError:
        return found, sql
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _own_queries() | _llm()[0]


def oracle_sql() -> dict[str, str]:
    return _own_oracle_sql() | _llm()[1]


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pack_by_label": pack_by_label,
        "unpack_vectors": unpack_vectors,
        "knn_flat_l2": knn_flat_l2,
        "knn_flat_ip": knn_flat_ip,
        "knn_flat_l1": knn_flat_l1,
        "knn_flat_linf": knn_flat_linf,
        "knn_array_form": knn_array_form,
        "knn_unnest_ordinality": knn_unnest_ordinality,
        "knn_packed_queries": knn_packed_queries,
        "range_flat_l2": range_flat_l2,
        "range_flat_ip": range_flat_ip,
        "range_array_form": range_array_form,
        "knn_tagged": knn_tagged,
        "sharded_local_topk": sharded_local_topk,
        "sharded_global_topk": sharded_global_topk,
        "topk_merge_lists": topk_merge_lists,
        "sql_knn": sql_knn,
        "sql_knn_tagged": sql_knn_tagged,
        "sql_range": sql_range,
        "series_arrays": series_arrays,
        "ivf_centroids": ivf_centroids,
        "ivf_postings": ivf_postings,
        "ivf_knn_nprobe2": ivf_knn_nprobe2,
        "ivf_knn_ip": ivf_knn_ip,
        "ivf_range_nprobe2": ivf_range_nprobe2,
        "ivf_knn_all_lists": ivf_knn_all_lists,
        "ivf_sharded_build": ivf_sharded_build,
        "ivf_sharded_knn": ivf_sharded_knn,
        "index_add_incremental": index_add_incremental,
        "index_reset": index_reset,
        "index_keyed_search": index_keyed_search,
        "build_index_pipeline": build_index_pipeline,
        "ivfpq_codes": ivfpq_codes,
        "ivfpq_knn": ivfpq_knn,
        "ivfpq_rerank_knn": ivfpq_rerank_knn,
        "ivfpq_range": ivfpq_range,
        "knn_nonfinite_vector": knn_nonfinite_vector,
        "range_nonfinite_vector": range_nonfinite_vector,
        "knn_repeated_query_ids": knn_repeated_query_ids,
        "build_without_ids": build_without_ids,
        "add_without_ids_sharded": add_without_ids_sharded,
        "index_keyed_range": index_keyed_range,
        "build_string_shards": build_string_shards,
        "ivf_global_merge": ivf_global_merge,
        "saved_index_search": saved_index_search,
        "ivf_range_exact": ivf_range_exact,
        "sharded_threshold_topk": sharded_threshold_topk,
        "ivf_knn_tagged": ivf_knn_tagged,
        "keyed_search_by_row": keyed_search_by_row,
        "stored_index_append": stored_index_append,
    }


# ---------------------------------------------------------------- SQL side

def _dist(a: str, b: str, metric: str = "l2") -> str:
    z = f"list_zip({a}, {b})"
    if metric == "l2":
        return f"list_sum(list_transform({z}, lambda z: (z[1]::DOUBLE - z[2]::DOUBLE)^2))"
    if metric == "ip":
        return f"list_sum(list_transform({z}, lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"
    if metric == "l1":
        return f"list_sum(list_transform({z}, lambda z: abs(z[1]::DOUBLE - z[2]::DOUBLE)))"
    return f"list_max(list_transform({z}, lambda z: abs(z[1]::DOUBLE - z[2]::DOUBLE)))"


V = "v AS (SELECT vec_id AS id, embedding AS vec, label FROM embeddings)"


def _topk(pairs: str, k: int = K, part: str = "query_idx", desc: bool = False, extra_cols: str = "") -> str:
    """Rank a (query_idx, vector_idx, distance[, extra]) relation and keep the best k."""
    order = "distance DESC" if desc else "distance"
    return (f"SELECT query_idx{extra_cols}, vector_idx, round(distance, 6) AS distance, ranking FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}, vector_idx) AS ranking "
            f"FROM ({pairs})) WHERE ranking <= {k}")


def _flat_pairs(metric="l2", where="", shard_expr=None) -> str:
    shard = f", {shard_expr} AS shard_id" if shard_expr else ""
    return (f"SELECT q.id AS query_idx, x.id AS vector_idx, {_dist('q.vec', 'x.vec', metric)} AS distance{shard} "
            f"FROM v q JOIN v x ON TRUE {where}")


def _lloyd(points: str, groups: list[str], k: int, iters: int, p: str, metric: str = "l2") -> tuple[list[str], str]:
    """CTEs of Lloyd k-means over ``points`` (groups..., id, v DOUBLE[]); returns (ctes, final centroid CTE)."""
    g = ", ".join(groups)
    gp = ", ".join(f"p.{c}" for c in groups)
    on = " AND ".join(f"p.{c} = c.{c}" for c in groups) or "TRUE"
    part = f"PARTITION BY {g}" if groups else ""
    first = "0" if k == 1 else f"(l.list_id * (p.n - 1)) // {k - 1}"
    ctes = [
        f"{p}_pts AS (SELECT *, row_number() OVER ({part} ORDER BY id) - 1 AS pos, "
        f"count(*) OVER ({part}) AS n FROM {points})",
        f"{p}_c0 AS (SELECT {gp + ', ' if groups else ''}l.list_id, p.v AS c FROM {p}_pts p "
        f"JOIN (SELECT range AS list_id FROM range({k})) l ON p.pos = {first})",
    ]
    for it in range(1, iters + 1):
        prev = f"{p}_c{it - 1}"
        ctes.append(_assign_cte(f"{p}_a{it}", f"{p}_pts", prev, groups, on, metric))
        sel = f"{g}, " if groups else ""
        ctes.append(
            f"{p}_m{it} AS (SELECT {sel}list_id, list(a ORDER BY i) AS c FROM ("
            f"SELECT {sel}list_id, i, avg(x) AS a FROM (SELECT {sel}list_id, unnest(v) AS x, "
            f"unnest(range(len(v))) AS i FROM {p}_a{it}) GROUP BY ALL) GROUP BY ALL)")
        using = ", ".join(groups + ["list_id"])
        osel = ", ".join(f"o.{c}" for c in groups)
        ctes.append(f"{p}_c{it} AS (SELECT {osel + ', ' if groups else ''}o.list_id, coalesce(m.c, o.c) AS c "
                    f"FROM {prev} o LEFT JOIN {p}_m{it} m USING ({using}))")
    return ctes, f"{p}_c{iters}"


def _assign_cte(name: str, pts: str, cents: str, groups: list[str], on: str, metric: str = "l2") -> str:
    gp = ", ".join(f"p.{c}" for c in groups)
    part = ", ".join([f"p.{c}" for c in groups] + ["p.id"])
    cols = ", ".join(groups + ["id", "v", "list_id"])
    return (f"{name} AS (SELECT {cols} FROM (SELECT {gp + ', ' if groups else ''}p.id, p.v, c.list_id, "
            f"row_number() OVER (PARTITION BY {part} ORDER BY {_dist('p.v', 'c.c', metric)}"
            f"{' DESC' if metric == 'ip' else ''}, c.list_id) AS rn "
            f"FROM {pts} p JOIN {cents} c ON {on}) WHERE rn = 1)")


def _ivf_ctes(nlist=NLIST, iters=ITERS, p="k", metric="l2") -> tuple[list[str], str, str]:
    """CTEs for an unsharded IVF build; returns (ctes, centroids CTE, postings CTE (id, v, list_id))."""
    pts = f"{p}p AS (SELECT id, vec::DOUBLE[] AS v FROM v)"
    ctes, cents = _lloyd(f"{p}p", [], nlist, iters, p, metric)
    ctes = [pts] + ctes + [_assign_cte(f"{p}_post", f"{p}_pts", cents, [], "TRUE", metric)]
    return ctes, cents, f"{p}_post"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _probe_pairs(cents: str, post: str, nprobe: int, radius: float | None = None, metric: str = "l2") -> str:
    desc = " DESC" if metric == "ip" else ""
    probe = (f"SELECT qid, list_id FROM (SELECT q.id AS qid, c.list_id, row_number() OVER (PARTITION BY q.id "
             f"ORDER BY {_dist('q.vec', 'c.c', metric)}{desc}, c.list_id) AS rn FROM v q JOIN {cents} c ON TRUE) "
             f"WHERE rn <= {nprobe}")
    pairs = (f"SELECT pr.qid AS query_idx, x.id AS vector_idx, {_dist('q.vec', 'x.v', metric)} AS distance "
             f"FROM ({probe}) pr JOIN {post} x ON x.list_id = pr.list_id JOIN v q ON q.id = pr.qid")
    if radius is not None:
        pairs = f"SELECT * FROM ({pairs}) WHERE distance < {radius}"
    return pairs


def _range_long(pairs: str) -> str:
    return f"SELECT query_idx, vector_idx, round(distance, 6) AS distance FROM ({pairs})"


def _pq_ctes() -> tuple[list[str], str, str]:
    """CTEs of the IVF-PQ build: coarse lists, residual codebooks, codes and reconstructions."""
    ctes, cents, post = _ivf_ctes(PQ_NLIST, PQ_ITERS, "pc")
    d = DIM // PQ_M
    ctes.append(f"res AS (SELECT x.id, x.list_id, list_transform(list_zip(x.v, c.c), lambda z: z[1] - z[2]) AS r "
                f"FROM {post} x JOIN {cents} c USING (list_id))")
    ctes.append(f"subs AS (SELECT id, list_id, s AS sub, r[s * {d} + 1:(s + 1) * {d}] AS v "
                f"FROM res JOIN (SELECT range AS s FROM range({PQ_M})) t ON TRUE)")
    cb_ctes, cb = _lloyd("subs", ["sub"], PQ_KS, PQ_ITERS, "cb")
    ctes += cb_ctes
    ctes.append(_assign_cte("codes", "subs", cb, ["sub"], "p.sub = c.sub"))
    ctes.append("coded AS (SELECT id, list(list_id ORDER BY sub) AS code FROM codes GROUP BY id)")
    ctes.append(f"recon AS (SELECT s.id, s.list_id, list_transform(list_zip(c.c, s.parts), lambda z: z[1] + z[2]) AS v "
                f"FROM (SELECT a.id, x.list_id, flatten(list(b.c ORDER BY a.sub)) AS parts FROM codes a "
                f"JOIN {cb} b ON b.sub = a.sub AND b.list_id = a.list_id JOIN {post} x ON x.id = a.id "
                f"GROUP BY a.id, x.list_id) s JOIN {cents} c USING (list_id))")
    return ctes, cents, post


def _own_oracle_sql() -> dict[str, str]:
    sq = {}
    sq["pack_by_label"] = (
        f"SELECT label, vec_id // {PAGE} AS page, list(vec_id ORDER BY vec_id) AS ids, "
        f"flatten(list(embedding ORDER BY vec_id)) AS vectors FROM embeddings GROUP BY label, page")
    sq["unpack_vectors"] = "SELECT vec_id AS id, embedding AS vector FROM embeddings"
    for metric in ("l2", "ip", "l1", "linf"):
        sq[f"knn_flat_{metric}"] = _with(V) + _topk(_flat_pairs(metric), desc=(metric == "ip"))
    ranked = (f"r AS (SELECT *, row_number() OVER (PARTITION BY query_idx ORDER BY distance, vector_idx) "
              f"AS ranking FROM ({_flat_pairs()}))")
    sq["knn_array_form"] = _with(V, ranked) + (
        "SELECT q.vec::FLOAT[] AS query_vector, q.id AS query_idx, list(r.vector_idx ORDER BY r.ranking) AS "
        "vector_idxs, list(r.distance::FLOAT ORDER BY r.ranking) AS distances FROM v q JOIN r "
        f"ON r.query_idx = q.id WHERE r.ranking <= {K} GROUP BY q.id, q.vec")
    sq["knn_packed_queries"] = sq["knn_array_form"]
    sq["knn_unnest_ordinality"] = _with(V, ranked) + (
        f"SELECT query_idx, vector_idx, distance::FLOAT AS distance, ranking FROM r WHERE ranking <= {K}")
    in_radius = f"SELECT * FROM ({_flat_pairs()}) WHERE distance < {RADIUS}"
    sq["range_flat_l2"] = _with(V) + _range_long(in_radius)
    sq["range_flat_ip"] = _with(V) + _range_long(f"SELECT * FROM ({_flat_pairs('ip')}) WHERE distance > {RADIUS_IP}")
    sq["range_array_form"] = _with(V, f"h AS ({in_radius})") + (
        "SELECT NULL::FLOAT[] AS query_vector, q.id AS query_idx, "
        "coalesce(list(h.vector_idx ORDER BY h.distance, h.vector_idx) FILTER (WHERE h.vector_idx IS NOT NULL), "
        "[]::BIGINT[]) AS vector_idxs, coalesce(list(h.distance::FLOAT ORDER BY h.distance, h.vector_idx) "
        "FILTER (WHERE h.vector_idx IS NOT NULL), []::FLOAT[]) AS distances "
        "FROM v q LEFT JOIN h ON h.query_idx = q.id GROUP BY q.id")
    sq["knn_tagged"] = _with(V) + _topk(_flat_pairs(where="AND x.label = 3"))
    sq["sharded_local_topk"] = _with(V) + (
        f"SELECT query_idx, shard_id::INTEGER AS shard_id, vector_idx, round(distance, 6) AS distance, ranking FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY query_idx, shard_id ORDER BY distance, vector_idx) AS ranking "
        f"FROM ({_flat_pairs(shard_expr=f'x.id % {SHARDS}')})) WHERE ranking <= {K}")
    sq["sharded_global_topk"] = sq["knn_flat_l2"]
    sq["sql_knn"], sq["sql_knn_tagged"], sq["sql_range"] = sq["knn_flat_l2"], sq["knn_tagged"], sq["range_flat_l2"]
    sq["series_arrays"] = ("SELECT vec_id AS id, (SELECT list(g::FLOAT ORDER BY g) FROM generate_series(vec_id, vec_id + 9) AS t(g)) "
                           "AS vector FROM embeddings")
    sq["topk_merge_lists"] = _with(V, f"t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_idx "
                                      f"ORDER BY distance, vector_idx) AS ranking FROM ({_flat_pairs()})) "
                                      f"WHERE ranking <= {K})") + (
        "SELECT query_idx, list(vector_idx ORDER BY ranking) AS idxs, list(round(distance, 6) ORDER BY ranking) "
        "AS distances FROM t GROUP BY query_idx")
    ivf, cents, post = _ivf_ctes()
    sq["ivf_centroids"] = _with(V, *ivf) + (
        f"SELECT list_id::INTEGER AS list_id, list_transform(c, lambda x: round(x, 6)) AS centroid FROM {cents}")
    sq["ivf_postings"] = _with(V, *ivf) + f"SELECT id, list_id::INTEGER AS list_id FROM {post}"
    sq["ivf_knn_nprobe2"] = _with(V, *ivf) + _topk(_probe_pairs(cents, post, NPROBE))
    ivf_ip, cents_ip, post_ip = _ivf_ctes(p="ki", metric="ip")
    sq["ivf_knn_ip"] = _with(V, *ivf_ip) + _topk(_probe_pairs(cents_ip, post_ip, NPROBE, metric="ip"), desc=True)
    sq["ivf_range_nprobe2"] = _with(V, *ivf) + _range_long(_probe_pairs(cents, post, NPROBE, RADIUS))
    sq["ivf_knn_all_lists"] = _with(V, *ivf) + _topk(_probe_pairs(cents, post, NLIST))
    sh_pts = f"sp AS (SELECT id % {SHARDS} AS shard_id, id, vec::DOUBLE[] AS v FROM v)"
    sh, sh_c = _lloyd("sp", ["shard_id"], 4, ITERS, "s")
    sq["ivf_sharded_build"] = _with(V, sh_pts, *sh, _assign_cte("s_post", "s_pts", sh_c, ["shard_id"],
                                                                "p.shard_id = c.shard_id")) + (
        "SELECT shard_id::INTEGER AS shard_id, list_id::INTEGER AS list_id, count(*) AS n FROM s_post "
        "GROUP BY ALL")
    sh_post = _assign_cte("s_post", "s_pts", sh_c, ["shard_id"], "p.shard_id = c.shard_id")
    sh_probe = (f"SELECT qid, shard_id, list_id FROM (SELECT q.id AS qid, c.shard_id, c.list_id, row_number() OVER "
                f"(PARTITION BY q.id, c.shard_id ORDER BY {_dist('q.vec', 'c.c')}, c.list_id) AS rn "
                f"FROM v q JOIN {sh_c} c ON TRUE) WHERE rn <= {NPROBE}")
    sh_pairs = (f"SELECT pr.qid AS query_idx, x.shard_id, x.id AS vector_idx, {_dist('q.vec', 'x.v')} AS distance "
                f"FROM ({sh_probe}) pr JOIN s_post x ON x.shard_id = pr.shard_id AND x.list_id = pr.list_id "
                f"JOIN v q ON q.id = pr.qid")
    sq["ivf_sharded_knn"] = _with(V, sh_pts, *sh, sh_post) + (
        f"SELECT query_idx, shard_id::INTEGER AS shard_id, vector_idx, round(distance, 6) AS distance, ranking FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY query_idx, shard_id ORDER BY distance, vector_idx) AS ranking "
        f"FROM ({sh_pairs})) WHERE ranking <= {K}")
    sq["index_add_incremental"] = _with(V, *ivf) + (
        f"SELECT list_id::INTEGER AS list_id, count(*) AS n FROM {post} GROUP BY ALL")
    sq["index_reset"] = ("SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, 0::INTEGER AS list_id, "
                         "embedding AS vector FROM embeddings")
    sq["index_keyed_search"] = _with(V) + _topk(_flat_pairs(where="AND x.id % 2 = 0"))
    sq["build_index_pipeline"] = sq["ivf_knn_all_lists"]
    pqc, pcents, ppost = _pq_ctes()
    sq["ivfpq_codes"] = _with(V, *pqc) + (
        f"SELECT x.id, x.list_id::INTEGER AS list_id, c.code::INTEGER[] AS code FROM {ppost} x JOIN coded c USING (id)")
    sq["ivfpq_knn"] = _with(V, *pqc) + _topk(_probe_pairs(pcents, "recon", NPROBE))
    cand = (f"cand AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_idx ORDER BY distance, "
            f"vector_idx) AS rn FROM ({_probe_pairs(pcents, 'recon', NPROBE)})) WHERE rn <= {RERANK})")
    exact = (f"SELECT c.query_idx, c.vector_idx, {_dist('q.vec', 'x.vec')} AS distance FROM cand c "
             f"JOIN v q ON q.id = c.query_idx JOIN v x ON x.id = c.vector_idx")
    sq["ivfpq_rerank_knn"] = _with(V, *pqc, cand) + _topk(exact)
    sq["ivfpq_range"] = _with(V, *pqc) + _range_long(_probe_pairs(pcents, "recon", NPROBE, RADIUS))
    finite = "AND q.id NOT IN (7, 11) AND x.id NOT IN (7, 11)"
    sq["knn_nonfinite_vector"] = _with(V) + _topk(_flat_pairs(where=finite))
    sq["range_nonfinite_vector"] = _with(V) + _range_long(
        f"SELECT * FROM ({_flat_pairs(where=finite)}) WHERE distance < {RADIUS}")
    sq["knn_repeated_query_ids"] = _with(V, ranked) + (
        "SELECT q.vec::FLOAT[] AS query_vector, q.label::BIGINT AS query_idx, list(r.vector_idx ORDER BY r.ranking) AS "
        "vector_idxs, list(round(r.distance::FLOAT::DOUBLE, 4) ORDER BY r.ranking) AS distances FROM v q JOIN r "
        f"ON r.query_idx = q.id WHERE r.ranking <= {K} GROUP BY q.id, q.label, q.vec")
    back = "v AS (SELECT row_number() OVER (ORDER BY vec_id DESC) - 1 AS id, embedding AS vec, label FROM embeddings)"
    sq["build_without_ids"] = _with(back, *ivf) + (
        f"SELECT list_id::INTEGER AS list_id, count(*) AS n, sum(id)::DECIMAL(38,0)::BIGINT AS ids FROM {post} GROUP BY list_id")
    sq["add_without_ids_sharded"] = (
        f"SELECT (vec_id % {SHARDS})::INTEGER AS shard_id, row_number() OVER (PARTITION BY vec_id % {SHARDS} "
        "ORDER BY label >= 5, vec_id) - 1 AS id, embedding AS vector FROM embeddings")
    sq["index_keyed_range"] = _with(V) + _range_long(
        f"SELECT * FROM ({_flat_pairs(where='AND x.id % 2 = 1')}) WHERE distance < {RADIUS}")
    sq["build_string_shards"] = (
        "SELECT CASE WHEN label <> 9 THEN 's' || (label % 3)::VARCHAR END AS shard, count(*) AS n, "
        "sum(vec_id)::BIGINT AS ids FROM embeddings GROUP BY 1")
    sq["ivf_global_merge"] = _with(V, sh_pts, *sh, sh_post) + _topk(f"SELECT query_idx, vector_idx, distance FROM ({sh_pairs})")
    sq["saved_index_search"] = sq["ivf_knn_nprobe2"]
    sq["stored_index_append"] = sq["ivf_knn_nprobe2"]
    sq["ivf_range_exact"] = sq["range_flat_l2"]
    sq["sharded_threshold_topk"] = sq["knn_flat_l2"]
    sq["keyed_search_by_row"] = _with(V) + _topk(_flat_pairs(where=f"AND x.id % {SHARDS} = q.label % {SHARDS}"))
    held = f"held AS (SELECT list_id, count(*) FILTER (WHERE v.label = 3) AS n FROM {post} x JOIN v USING (id) GROUP BY list_id)"
    ranked_lists = (f"lists AS (SELECT q.id AS qid, c.list_id, h.n, row_number() OVER w AS rn, coalesce(sum(h.n) OVER "
                    f"(PARTITION BY q.id ORDER BY {_dist('q.vec', 'c.c')}, c.list_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
                    f"AS before FROM v q JOIN {cents} c ON TRUE LEFT JOIN held h USING (list_id) "
                    f"WINDOW w AS (PARTITION BY q.id ORDER BY {_dist('q.vec', 'c.c')}, c.list_id))")
    sq["ivf_knn_tagged"] = _with(V, *ivf, held, ranked_lists) + _topk(
        f"SELECT l.qid AS query_idx, x.id AS vector_idx, {_dist('q.vec', 'x.v')} AS distance FROM lists l JOIN {post} x USING (list_id) "
        f"JOIN v t ON t.id = x.id JOIN v q ON q.id = l.qid WHERE t.label = 3 AND (l.before < {K} OR l.rn <= 1)")
    return sq
