"""Nearest neighbours by cosine with vantage-point trees, one per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` rows by a hash; each
shard's tree is built in one task and stored as one row.  Query vectors are
packed into blocks of ``QUERY_BLOCK`` and every block meets every tree (an
equi-join on the shard number, of blocks and trees, never of rows), so a
task holds one tree and one block at a time.  A tree is searched for a whole
block at once.  The best ``k`` of each query and shard are merged by a
grouped aggregate that keeps ``k`` rows.

On unit vectors the chord ``sqrt(2 - 2 cos)`` is a metric and falls with
the cosine.  A subtree whose vectors lie between ``lo`` and ``hi`` from its
vantage point has nothing nearer than ``max(d - hi, lo - d)``.  It is passed
over where that exceeds ``factor`` times the query's current ``k``-th
distance: ``factor`` one is exact search, smaller ones trade recall.

Scores are sums in component order, in double precision, of the original
vectors; candidates within rounding of the ``k``-th are all scored so, and
ties go to the smaller id.

Defined results: a vector that is null, zero, or has a null or non-finite
component takes no part, as query or as candidate; vectors of another
length are never candidates of a query; a query's own rows (equal id) are
no candidates; null ids take no part.  Rows of equal id and vector are one
row; a row that repeats an id with another vector is a candidate and a query of
its own, with its own ``k`` ranks.  An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.common import stored

SHARD_ROWS = 8192
QUERY_BLOCK = 1024
LEAF = 128
EPS = 1e-7  # rounding of chords; pruning stays on the safe side


class VPTree:
    """Tree over the rows of one shard; nodes are tuples over a row order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, seed: int = 3):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order], dtype=np.float64)
        self.unit = self.vectors / np.sqrt((self.vectors**2).sum(1))[:, None]
        self.rng, self.leaf = np.random.default_rng(seed), leaf
        self.order = np.arange(len(ids))
        self.root = self._build(0, len(ids))
        del self.rng
        self.ids, self.vectors, self.unit = self.ids[self.order], self.vectors[self.order], self.unit[self.order]

    def _build(self, a: int, b: int):
        """``(a, b)`` for a leaf, else ``(vantage, inner, outer, bounds)``; halves by rank, so ties cannot degrade it."""
        if b - a <= self.leaf:
            return (a, b)
        rows = self.order[a:b]
        pick = int(self.rng.integers(len(rows)))
        vantage = self.unit[rows[pick]]
        d = chord(self.unit[rows] @ vantage)
        by = np.argsort(d, kind="stable")
        self.order[a:b], d = rows[by], d[by]
        half = (b - a) // 2
        bounds = (d[0], d[half - 1], d[half], d[-1])
        return (vantage, self._build(a, a + half), self._build(a + half, b), bounds)

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float = 1.0):
        """``(query row, id, score)`` arrays of each query's best ``k`` other ids."""
        unit = queries / np.sqrt((queries**2).sum(1))[:, None]
        run = _Search(self, ids, queries, unit, k, factor)
        run.visit(self.root, np.arange(len(ids)))
        return run.row, run.found, run.score


def chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of row pairs, each sum taken in component order."""
    dot, na, nb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for j in range(a.shape[1]):
        x, y = a[:, j], b[:, j]
        dot += x * y
        na += x * x
        nb += y * y
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        both = np.sqrt(na * nb)
        both = np.where(np.isfinite(both) & (both > 0), both, np.sqrt(na) * np.sqrt(nb))
        return np.clip(dot / both, -1.0, 1.0)


class _Search:
    def __init__(self, tree, ids, queries, unit, k, factor):
        self.tree, self.ids, self.queries, self.unit, self.k, self.factor = tree, ids, queries, unit, k, factor
        self.kth = np.full(len(ids), -np.inf)  # cosine of the k-th best so far
        self.row = np.zeros(0, dtype=np.int64)
        self.found = np.zeros(0, dtype=tree.ids.dtype)
        self.score = np.zeros(0)
        self.compared = 0

    def visit(self, node, rows: np.ndarray) -> None:
        if len(rows) == 0:
            return
        if len(node) == 2:
            self._leaf(*node, rows)
            return
        vantage, inner, outer, (a, b, c, d) = node
        at = chord(self.unit[rows] @ vantage)
        near = at <= (b + c) / 2
        self.visit(inner, rows[near])
        self.visit(outer, rows[~near])
        self._far(inner, rows[~near], at[~near], a, b)
        self._far(outer, rows[near], at[near], c, d)

    def _far(self, node, rows, at, lo, hi) -> None:
        least = np.maximum(at - hi, lo - at)
        with np.errstate(invalid="ignore"):
            reach = np.where(np.isfinite(self.kth[rows]), chord(self.kth[rows]) * self.factor, np.inf)
        self.visit(node, rows[least <= reach + EPS])

    def _leaf(self, a: int, b: int, rows: np.ndarray) -> None:
        self.compared += len(rows) * (b - a)
        rough = self.unit[rows] @ self.tree.unit[a:b].T
        q, v = np.nonzero((rough >= self.kth[rows][:, None] - 1e-9) & (self.ids[rows][:, None] != self.tree.ids[a:b][None]))
        if len(q) == 0:
            return
        score = np.concatenate([cosine(self.queries[rows[q[i:i + 65536]]], self.tree.vectors[a + v[i:i + 65536]])
                                for i in range(0, len(q), 65536)])
        row = np.concatenate((self.row, rows[q]))
        found = np.concatenate((self.found, self.tree.ids[a + v]))
        score = np.concatenate((self.score, score))
        order = np.lexsort((found, -score, row))
        row, found, score = row[order], found[order], score[order]
        first = np.searchsorted(row, row)
        kept = np.arange(len(row)) - first < self.k
        self.row, self.found, self.score = row[kept], found[kept], score[kept]
        last = np.flatnonzero(np.arange(len(self.row)) - np.searchsorted(self.row, self.row) == self.k - 1)
        self.kth[self.row[last]] = self.score[last]


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` (doubles) of the rows that take part."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
                      & finite & F.exists("vector", lambda x: x != 0))


def _once(rows: DataFrame) -> DataFrame:
    """Equal rows as one; only rows of repeated ids are dealt for it."""
    twice = stored(rows.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id"), "repeated_ids")
    if twice.isEmpty():
        return rows
    return rows.join(twice, "id", "left_anti").unionAll(rows.join(twice, "id", "left_semi").distinct())


def build_trees(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """Stored ``shard, dim, tree`` rows and the number of shards."""
    shards = max(1, -(-rows.count() // shard_rows))

    def build(key, table):
        tree = VPTree(table.column("id").to_numpy(),
                      table.column("vector").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([key[1].as_py()], pa.int32()),
                         "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    dealt = rows.select("id", "vector", F.size("vector").alias("dim"),
                        F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int").alias("shard"))
    trees = dealt.groupBy("shard", "dim").applyInArrow(build, "shard int, dim int, tree binary")
    return stored(trees, "vp_trees"), shards


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest vectors."""
    rows = _once(_usable(vectors, id_col, vector_col))
    trees, shards = build_trees(rows, shard_rows)
    asked = _once(_usable(queries, id_col, vector_col)).select("id", "vector", F.size("vector").alias("dim"))
    blocks = max(1, -(-asked.count() // query_block))
    packed = (asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(9)), F.lit(blocks)))
              .groupBy("block", "dim").agg(F.sort_array(F.collect_list(F.struct("id", "vector"))).alias("block_rows"))
              .select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                      F.col("block_rows.id").alias("ids"), F.flatten("block_rows.vector").alias("values")))
    kind = rows.schema["id"].dataType.simpleString()

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                tree = pickle.loads(batch.column("tree")[i].as_py())
                ids = batch.column("ids")[i].values.to_numpy()
                queries = batch.column("values")[i].values.to_numpy().reshape(len(ids), -1)
                row, found, score = tree.search(ids, queries, k, factor)
                own = np.array([int.from_bytes(hashlib.blake2b(v.tobytes(), digest_size=8).digest(), "little", signed=True) for v in queries], dtype=np.int64)
                yield pa.RecordBatch.from_pydict({"query_id": ids[row], "q": own[row], "vec_id": found, "score": score})

    # Never a broadcast: the blocks times the shards are far more than the size Spark has measured of the blocks.
    pairs = packed.hint("merge").join(trees.hint("merge"), ["shard", "dim"]).select("ids", "values", "tree")
    found = pairs.mapInArrow(search, f"query_id {kind}, q bigint, vec_id {kind}, score double")
    # The k best of each query and shard arrive; k of them stay.
    best = found.groupBy("query_id", "q").agg(F.slice(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("order"), "vec_id", "score"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("p", "b")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


def op8_vp_tree(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP8_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""
