"""Vector codes by product quantization, with cover-tree Lloyd iterations.

Vectors are scaled to whole numbers and cut into ``parts`` equal consecutive
parts.  Each part position has a codebook of ``entries`` vectors, which
starts as that part of the rows of the smallest ids.

1. Blocks.  Every task cuts its rows into blocks of ``BLOCK_ROWS`` and builds
   one cover tree a block and part position.  A node covers its points
   within its radius; its children lie more than half the parent's scale apart
   and cover its points within that.  Points are held in tree order with
   cumulative sums, so the sum of any subtree is one difference.  Blocks are
   stored once.
2. Rounds.  Nodes meet the codebook level by level.  Where the nearest entry
   is nearer than any other by more than twice the node's radius, the triangle
   inequality gives the whole subtree to it, and its sum and count are added
   at once; entries that cannot win are dropped for the subtree; only
   ambiguous nodes descend, in the end to exact comparisons of their points.
   Distances are exact whole numbers, and equal ones go to the lower entry, so
   the result is that of comparing every point with every entry.
3. Each task sends one array of sums and counts; the new codebook (``entries``
   vectors, whatever the table's size) is the driver's only state.

Defined results: rows whose vector is null, empty, or has a null or
non-finite component take no part, nor do those whose length is not that of
the row with the smallest id (length a multiple of ``parts``), or whose scaled
components are so large that an error might not fit a BIGINT.  Null ids come
last in the order, equal ids in the order of their vectors, and every row has
its code.  With fewer than ``entries`` rows the codebooks are that much
smaller.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.llm.common import finite_vectors, matrix, stored, summed

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_ROWS = 4096
LEAF = 24
_FAR = np.iinfo(np.int64).max


class CoverTree:
    """Cover tree over the rows of one block, for one part position.

    Nodes are numbered level by level, so the children of a node are
    consecutive: ``first[i]:first[i] + children[i]``.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        order, nodes = np.arange(len(points)), []
        level = [(0, len(points), points[0], _squares(points, points[0]), None)]
        while level:
            following = []
            for a, b, center, d, scale in level:
                reach = float(np.sqrt(d.max()))
                node = [center, reach, a, b, 0, 0]
                nodes.append(node)
                if b - a <= leaf or reach == 0.0:
                    continue
                half = min(reach, np.inf if scale is None else scale) / 2
                node[4], rows, at = len(following), order[a:b].copy(), a
                # Greedy net: the first point not covered yet becomes a centre.
                while len(rows):
                    near = d <= half * half
                    own, node[5] = rows[near], node[5] + 1
                    order[at:at + len(own)] = own
                    following.append((at, at + len(own), center, d[near], half))
                    at += len(own)
                    rows = rows[~near]
                    if len(rows):
                        center = points[rows[0]]
                        d = _squares(points[rows], center)
            base = len(nodes)
            for node in nodes[base - len(level):]:
                node[4] += base
            level = following
        center, reach, a, b, first, children = zip(*nodes, strict=True)
        self.center, self.radius = np.array(center), np.array(reach)
        self.start, self.end = np.array(a), np.array(b)
        self.first, self.children = np.array(first), np.array(children)
        self.order = order

    def assign(self, points: np.ndarray, entries: np.ndarray, rows_too: bool = False):
        """``sums, counts`` per entry, and each row's entry (None unless ``rows_too``); also counts exact comparisons."""
        k = len(entries)
        ordered = points[self.order]
        cumulative = np.concatenate((np.zeros((1, ordered.shape[1]), dtype=np.int64), np.cumsum(ordered, axis=0)))
        sums, counts = np.zeros((k, ordered.shape[1]), dtype=np.int64), np.zeros(k, dtype=np.int64)
        found = np.zeros(len(points), dtype=np.int64) if rows_too else None
        self.compared = 0
        nodes, open_ = np.zeros(1, dtype=np.int64), np.ones((1, k), dtype=bool)
        while len(nodes):
            d = np.where(open_, _all_squares(self.center[nodes], entries), _FAR)
            best = d.argmin(1)
            root = np.sqrt(d.astype(np.float64))
            nearest, radius = root[np.arange(len(nodes)), best], self.radius[nodes]
            limit = nearest + 2 * radius
            open_ &= root <= (limit * (1 + 1e-9) + 1e-9)[:, None]
            whole = (open_.sum(1) == 1) | (radius == 0)
            own = nodes[whole]
            np.add.at(sums, best[whole], cumulative[self.end[own]] - cumulative[self.start[own]])
            np.add.at(counts, best[whole], self.end[own] - self.start[own])
            if rows_too:
                found[self.order[_spans(self.start[own], self.end[own])]] = np.repeat(best[whole], self.end[own] - self.start[own])
            leaf = ~whole & (self.children[nodes] == 0)
            own = nodes[leaf]
            if len(own):
                size = self.end[own] - self.start[own]
                place = _spans(self.start[own], self.end[own])
                d = np.where(np.repeat(open_[leaf], size, axis=0), _all_squares(ordered[place], entries), _FAR)
                self.compared += int((d < _FAR).sum())
                best = d.argmin(1)
                np.add.at(sums, best, ordered[place])
                counts += np.bincount(best, minlength=k)
                if rows_too:
                    found[self.order[place]] = best
            below = ~whole & ~leaf
            own = nodes[below]
            open_ = np.repeat(open_[below], self.children[own], axis=0)
            nodes = _spans(self.first[own], self.first[own] + self.children[own])
        return sums, counts, found


def _squares(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return ((points - center) ** 2).sum(1)


def _all_squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances; the parts of a vector are short, so components are added one by one."""
    d = np.zeros((len(points), len(entries)), dtype=np.int64)
    for j in range(points.shape[1]):
        d += (points[:, j, None] - entries[None, :, j]) ** 2
    return d


def _spans(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``first[i] ... end[i] - 1`` of all i, one after another."""
    n = end - first
    return np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Codebooks:
    """``entries``: (parts, entries, components) whole numbers."""

    entries: np.ndarray
    scale: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors * float(scale)).astype(np.int64)


def _blocks(rows: DataFrame, parts: int, scale: int) -> DataFrame:
    """``rows`` (kept columns), ``points`` and ``trees`` of each block."""

    def block(held, vectors):
        x = _scaled(np.concatenate(vectors), scale)
        trees = [CoverTree(p) for p in np.split(x, parts, axis=1)]
        small = np.int32 if np.abs(x).max() < 2**31 else np.int64
        kept = pa.concat_arrays(held)
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept),
             pa.array([pickle.dumps(x.astype(small))], pa.binary()), pa.array([pickle.dumps(trees)], pa.binary())],
            names=["rows", "points", "trees"])

    def run(batches):
        held, vectors, size = [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, BLOCK_ROWS - size)
                at += part.num_rows
                size += part.num_rows
                held.append(part.column("row")), vectors.append(matrix(part.column("vector")))
                if size == BLOCK_ROWS:
                    yield block(held, vectors)
                    held, vectors, size = [], [], 0
        if size:
            yield block(held, vectors)

    kind = T.StructType([T.StructField("rows", T.ArrayType(rows.schema["row"].dataType)),
                         T.StructField("points", T.BinaryType()), T.StructField("trees", T.BinaryType())])
    return rows.mapInArrow(run, kind)


def _opened(batch: pa.RecordBatch, i: int, parts: int):
    points = pickle.loads(batch.column("points")[i].as_py()).astype(np.int64)
    return np.split(points, parts, axis=1), pickle.loads(batch.column("trees")[i].as_py())


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The next codebooks."""
    parts, k, width = books.shape

    def run(batches):
        total = np.zeros((parts, k, width + 1), dtype=np.int64)
        seen = False
        for batch in batches:
            for i in range(batch.num_rows):
                points, trees = _opened(batch, i, parts)
                for p in range(parts):
                    sums, counts, _ = trees[p].assign(points[p], books[p])
                    total[p, :, :width] += sums
                    total[p, :, width] += counts
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1)])], names=["v"])

    total = summed(blocks.select("points", "trees").mapInArrow(run, "v array<bigint>")).reshape(parts, k, width + 1)
    out = books.copy()
    for p, e in zip(*np.nonzero(total[:, :, width]), strict=True):
        out[p, e] = [s // total[p, e, width] for s in total[p, e, :width]]
    return out


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = (), *,
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """``id_col, *keep, code`` (entry numbers), ``errors`` (squared distances by part) of every row that takes part, and the codebooks."""
    rows = finite_vectors(vectors, vector_col, list(dict.fromkeys([id_col, *keep])))
    order = [F.col(f"row.`{id_col}`").asc_nulls_last(), F.col("vector")]
    first = rows.where(F.size("vector") % parts == 0).orderBy(*order).select(F.size("vector").alias("n")).first()
    width = first["n"] if first else parts
    most = float(int((2**60 / width) ** 0.5)) / scale - 1
    rows = rows.where((F.size("vector") == width) & F.forall("vector", lambda x: F.abs(x) < most))
    seeds = np.array([r["vector"] for r in rows.orderBy(*order).limit(entries).select("vector").collect()], dtype=np.float64)
    blocks = stored(_blocks(rows, parts, scale), "cover_trees")
    books = np.zeros((parts, 0, width // parts), dtype=np.int64)
    if len(seeds):
        books = _scaled(seeds, scale).reshape(len(seeds), parts, width // parts).transpose(1, 0, 2).copy()
        for _ in range(rounds):
            books = _round(blocks, books)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                points, trees = _opened(batch, i, parts)
                codes = np.stack([trees[p].assign(points[p], books[p], True)[2] for p in range(parts)], 1)
                errors = np.stack([((points[p] - books[p][codes[:, p]]) ** 2).sum(1) for p in range(parts)], 1)
                ends = pa.array(np.arange(0, codes.size + 1, parts), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rows")[i].values, pa.ListArray.from_arrays(ends, pa.array(codes.reshape(-1).astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(errors.reshape(-1)))], names=["row", "code", "errors"])

    kind = T.StructType([rows.schema["row"], T.StructField("code", T.ArrayType(T.IntegerType())),
                         T.StructField("errors", T.ArrayType(T.LongType()))])
    coded = blocks.mapInArrow(run, kind).select("row.*", "code", "errors")
    return coded, Codebooks(books, scale)


def total_by(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over rows of an equal key, nulls together.

    Keys holding a thousandth of the rows or more are at most a thousand: their
    sums are broadcast, so no hot key is dealt to one task; the others are joined.
    """
    sums = rows.groupBy(key).agg(F.sum(value).alias("_total"), F.count(F.lit(1)).alias("_n"))
    sums = stored(sums.withColumnRenamed(key, "_key"), "totals")
    n = sums.agg(F.sum("_n")).first()[0] or 0
    same = F.col(key).eqNullSafe(F.col("_key"))
    busy, rest = F.broadcast(sums.where(F.col("_n") * 1000 >= n)), sums.where(F.col("_n") * 1000 < n)
    both = rows.join(busy, same).unionAll(rows.join(busy, same, "left_anti").join(rest, same))
    return both.select(*rows.columns, F.col("_total").alias(name))


def op11_cover_codes(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    coded, books = compress(table(spark, sf_dir, "embeddings"), keep=("label",))
    digits = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c.cast("bigint")), 2, "0"))), "")
    error = F.aggregate("errors", F.lit(0).cast("bigint"), lambda a, e: a + e)
    rows = stored(coded.select("vec_id", "label", digits.alias("code"), error.alias("error")), "codes")
    return total_by(rows, "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _op11_sql() -> str:
    """Lloyd iterations unrolled; the parts are rows, floors of quotients by whole numbers alone."""
    ctes = [
        "k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda c: floor(4096 * c::DOUBLE)::BIGINT) AS x FROM "
        "embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)",
        f"p AS MATERIALIZED (SELECT vec_id, label, s AS part, x[s * (len(x) // 8) + 1:(s + 1) * (len(x) // 8)] AS v "
        f"FROM k, unnest(range(8)) AS t(s))",
        "c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS c FROM p "
        "QUALIFY entry < 16)",
    ]
    distance = "list_sum(list_transform(list_zip(p.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(1, ROUNDS + 2):
        ctes.append(f"a{i} AS MATERIALIZED (SELECT vec_id, part, any_value(label) AS label, any_value(v) AS v, "
                    f"min({{'d': d, 'e': entry}}) AS b FROM (SELECT p.*, c.entry, {distance} AS d FROM p JOIN c{i - 1} c USING (part)) "
                    "GROUP BY vec_id, part)")
        if i <= ROUNDS:
            ctes.append(f"m{i} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY j) AS c FROM (SELECT part, b.e AS entry, j, "
                        f"sum(v[j])::BIGINT AS s, count(*) AS n FROM a{i}, unnest(range(1, len(v) + 1)) AS t(j) GROUP BY ALL) GROUP BY ALL)")
            ctes.append(f"c{i} AS MATERIALIZED (SELECT o.part, o.entry, coalesce(m.c, o.c) AS c FROM c{i - 1} o "
                        f"LEFT JOIN m{i} m USING (part, entry))")
    last = ROUNDS + 1
    ctes.append(f"r AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', b.e), '' ORDER BY part) AS code, "
                f"sum(b.d)::BIGINT AS error FROM a{last} GROUP BY vec_id)")
    ctes.append("h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 "
                f"FROM c{ROUNDS})")
    return ("WITH " + ",\n".join(ctes) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, "
            "codebooks_sha256 FROM r, h")


OP11_SQL = _op11_sql()
