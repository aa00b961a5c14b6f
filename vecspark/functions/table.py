"""Nearest-neighbour search from SQL text.

``register_sql(spark)`` makes these known to ``spark.sql``:

``vec_nearest(TABLE(...) PARTITION BY (...) ORDER BY (is_item), k, radius, metric)``
    an Arrow table function.  Its rows are ``is_item, id, vector``: in each
    partition of its table (a tile of the items and a block of the queries,
    whatever columns name them) every item meets every query, and the ``k``
    nearest, or all nearer than ``radius``, of each query are returned as
    ``query_idx, vector_idx, distance``.  A task holds the queries of one
    partition and one batch of items.
``vec_l2``, ``vec_ip``, ``vec_l1``, ``vec_linf``
    distances of two arrays as SQL functions, evaluated by the JVM.

``knn_sql`` and ``range_sql`` give the text of a whole search over named
tables or views: tiles by a hash of the id, the table function, and the
merge of its partial lists by rank.  A condition on the items is part of
their scan, so it reaches the files of a stored index (``register_index``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

from vecspark.functions import kernels
from vecspark.functions.distance import distance_sql
from vecspark.model import VectorIndex, metric_name, positive_int
from vecspark.session import ensure_importable

TILE_ROWS = 65_536  # items of a tile
RADIUS_ROWS = 512  # items whose hits within a radius leave a task at once
BLOCK_ROWS = 4_096  # queries of a block, which a task holds
_HITS = "query_idx bigint, vector_idx bigint, distance double"


class VecNearest:
    """One instance a partition: its queries come first, then its items in batches."""

    def __init__(self):
        self.rows, self.best, self.matrix = [], None, None  # of the queries; the best hits so far

    def eval(self, table: pa.RecordBatch, k: pa.Array, radius: pa.Array, metric: pa.Array):
        self.k, self.radius, self.metric = k[0].as_py(), radius[0].as_py(), metric[0].as_py()
        items = table.column("is_item")
        rows = table.select(["id", "vector"])
        asked = rows.filter(pc.invert(items))
        if asked.num_rows:
            self.rows.append(asked)
        stored = rows.filter(items)
        if stored.num_rows and self.rows:
            yield from self._met(stored)

    def _met(self, stored: pa.RecordBatch):
        vectors = stored.column("vector")
        if vectors.null_count:
            raise ValueError("vector column holds NULL vectors")
        dim = len(vectors[0])
        if self.matrix is None:
            self.ids = np.concatenate([r.column("id").to_numpy(zero_copy_only=False) for r in self.rows])
            self.matrix = np.concatenate([kernels.list_matrix(r.column("vector"), dim) for r in self.rows])
        ids, matrix = stored.column("id").to_numpy(zero_copy_only=False), kernels.list_matrix(vectors, dim)
        if self.radius is not None:
            for at in range(0, len(ids), RADIUS_ROWS):
                part = ids[at:at + RADIUS_ROWS]
                q, v, d = kernels.search_block(self.matrix, matrix[at:at + RADIUS_ROWS], part, self.metric, radius=self.radius)
                yield self._hits(q, part[v], d)
            return
        q, v, d = kernels.search_block(self.matrix, matrix, ids, self.metric, k=self.k)
        found = q, ids[v], d
        if self.best is not None:
            found = tuple(np.concatenate(x) for x in zip(self.best, found, strict=True))
        q, at, d = kernels.rank_pairs(found[0], np.arange(len(found[0])), found[2], found[1], self.k, kernels.larger_is_nearer(self.metric))
        self.best = q, found[1][at], d

    def _hits(self, q, ids, d) -> pa.Table:
        return pa.table({"query_idx": pa.array(self.ids[q], pa.int64()), "vector_idx": pa.array(ids, pa.int64()),
                         "distance": pa.array(d, pa.float64())})

    def terminate(self):
        if self.best is not None:
            yield self._hits(*self.best)


def register_sql(spark: SparkSession) -> None:
    """Register ``vec_nearest`` and the distance functions with the session."""
    ensure_importable(spark)
    spark.udtf.register("vec_nearest", arrow_udtf(VecNearest, returnType=_HITS))
    for metric in ("l2", "ip", "l1", "linf"):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION vec_{metric}(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) "
                  f"RETURNS DOUBLE RETURN {distance_sql('a', 'b', metric)}")


def register_index(index: VectorIndex, name: str) -> None:
    """Views of an index for SQL: ``name`` (its rows) and, with lists, ``name_lists`` (their centroids)."""
    index.postings.createOrReplaceTempView(name)
    if index.centroids is not None:
        index.centroids.createOrReplaceTempView(f"{name}_lists")


def _search(items, queries, k, radius, metric, where, item_id, query_id, item_vector, query_vector) -> str:
    kept = f" WHERE {where}" if where else ""
    tiles = f"greatest(1, (SELECT ceil(count(*) / {TILE_ROWS}) FROM {items}{kept}))"
    blocks = f"greatest(1, (SELECT ceil(count(*) / {BLOCK_ROWS}) FROM {queries}))"

    def side(flag, table, ident, vector, condition, own, own_count, other, other_count):
        return (f"SELECT {flag} AS is_item, CAST({ident} AS BIGINT) AS id, {vector} AS vector, "
                f"CAST(pmod(xxhash64({ident}), {own_count}) AS INT) AS {own}, "
                f"explode(sequence(0, CAST({other_count} - 1 AS INT))) AS {other} FROM {table}{condition}")

    rows = (side("true", items, item_id, item_vector, kept, "tile", tiles, "block", blocks) + " UNION ALL "
            + "SELECT is_item, id, vector, tile, block FROM ("
            + side("false", queries, query_id, query_vector, "", "block", blocks, "tile", tiles) + ")")
    limit = "CAST(NULL AS INT)" if k is None else str(k)
    reach = "CAST(NULL AS DOUBLE)" if radius is None else f"{float(radius)!r}D"
    return (f"SELECT query_idx, vector_idx, distance FROM vec_nearest(TABLE({rows}) PARTITION BY (tile, block) "
            f"ORDER BY (is_item), {limit}, {reach}, '{metric}')")


def knn_sql(items: str, queries: str, k: int, *, metric="l2", where: str | None = None, item_id: str = "id", query_id: str = "id",
            item_vector: str = "vector", query_vector: str = "vector") -> str:
    """SQL text: ``query_idx, vector_idx, distance, ranking`` of the k nearest ``items`` of each row of ``queries``.

    Both are names of tables or views; the ids of the queries are distinct.
    ``where`` is a condition on the items.
    """
    m, k = metric_name(metric), positive_int("k", k)
    order = "distance DESC" if kernels.larger_is_nearer(m) else "distance"
    hits = _search(items, queries, k, None, m, where, item_id, query_id, item_vector, query_vector)
    return (f"SELECT query_idx, vector_idx, distance, CAST(ranking AS BIGINT) AS ranking FROM (SELECT *, row_number() OVER ("
            f"PARTITION BY query_idx ORDER BY {order}, vector_idx) AS ranking FROM ({hits})) WHERE ranking <= {k}")


def range_sql(items: str, queries: str, radius: float, *, metric="l2", where: str | None = None, item_id: str = "id",
              query_id: str = "id", item_vector: str = "vector", query_vector: str = "vector") -> str:
    """SQL text: ``query_idx, vector_idx, distance`` of all ``items`` nearer than ``radius`` to a row of ``queries``."""
    return _search(items, queries, None, radius, metric_name(metric), where, item_id, query_id, item_vector, query_vector)
