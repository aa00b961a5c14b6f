"""Packed vectors: many vectors in one flat array, and back.

The reference feeds its index functions one flat ``REAL[]`` per call.  Here
packing is an edge format only (the core keeps one row per vector), and a
pack never grows without bound: with ``page_size`` the rows of each group
are cut into pages of ids ``[p*page_size, (p+1)*page_size)``, so a page
holds at most ``page_size`` vectors and the whole group is the pages in
``page`` order.  Ids and vectors are packed from the same id-sorted list,
so position i of ``ids`` belongs to vector i of ``vectors``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.model import positive_int
from vecspark.operators.ranking import with_positions


DEFAULT_PAGE = 65536


def pack_vectors(df: DataFrame, *, by=(), id_col: str = "id", vector_col: str = "vector",
                 page_size: int | None = DEFAULT_PAGE) -> DataFrame:
    """``by..., [page,] ids ARRAY<LONG>, vectors ARRAY<FLOAT>`` (V1, V2), ids ascending.

    ``page_size=None`` packs each whole group into one row, as the
    reference does; that row is unbounded, so the default cuts pages.  An
    empty input gives no rows, or, with neither ``by`` nor pages, one row of
    NULLs.
    """
    by = list(by)
    keys = list(by)
    src = df
    if page_size is not None:
        page_size = positive_int("page_size", page_size)
        src = src.withColumn("page", F.floor(F.col(id_col) / F.lit(page_size)).cast("long"))
        keys.append("page")
    v = F.col(vector_col)
    checked = F.when(v.isNull() | F.exists(v, lambda x: x.isNull()),
                     F.raise_error(F.lit("cannot pack a NULL vector or NULL element"))).otherwise(v)
    grouped = src.groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.struct(F.col(id_col).cast("long").alias("i"), checked.cast(T.ArrayType(T.FloatType())).alias("v"))))
        .alias("_s"))
    ids = F.transform("_s", lambda s: s["i"])
    vectors = F.flatten(F.transform("_s", lambda s: s["v"]))
    if not keys:  # an ungrouped pack of zero rows is NULL, as an aggregate over nothing
        empty = F.size("_s") == 0
        ids = F.when(~empty, ids)
        vectors = F.when(~empty, vectors)
    return grouped.select(*keys, ids.alias("ids"), vectors.alias("vectors"))


def array_1d_extend(df: DataFrame, vector_col: str = "vector", *, order_col: str = "id", by=(),
                    page_size: int | None = DEFAULT_PAGE) -> DataFrame:
    """Concatenate the vectors of each group in ``order_col`` order (V1).

    Any orderable column will do.  Pages of an integer column hold the ids of
    one page range; another column's rows are numbered first (NULLs first,
    ties by content) and the pages cut by that number.
    """
    by = list(by)
    if df.schema[order_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        df = with_positions(df.select(*by, order_col, vector_col), [order_col], by, name="_ordinal")
        order_col = "_ordinal"
    packed = pack_vectors(df, by=by, id_col=order_col, vector_col=vector_col, page_size=page_size)
    return packed.drop("ids")


def unpack_vectors(df: DataFrame, dim: int, *, ids_col: str | None = "ids", vectors_col: str = "vectors",
                   keep=()) -> DataFrame:
    """Inverse of packing (V3): one row ``keep..., id, vector`` per dim-sized slice.

    Without ids, ``id`` is the position inside the packed array.  A length
    that is not a multiple of ``dim``, or an id count that differs from the
    vector count, is an error (the reference silently truncated).
    """
    dim = positive_int("dim", dim)
    vecs = F.col(vectors_col)
    n = F.size(vecs)
    nvec = F.floor(n / dim).cast("int")
    bad = vecs.isNull() | (n % dim != 0)
    if ids_col is not None:
        bad = bad | F.col(ids_col).isNull() | (F.size(F.col(ids_col)) != nvec)
    checked = F.when(bad, F.raise_error(F.lit(
        f"packed vectors must be a multiple of dim {dim} long, with one id per vector"))).otherwise(nvec)
    slices = F.transform(F.sequence(F.lit(0), F.greatest(checked - 1, F.lit(0))),
                         lambda i: F.struct(i.alias("p"), F.slice(vecs, i * dim + 1, dim).alias("v")))
    slices = F.when(checked > 0, slices).otherwise(F.array())
    ex = df.select(*keep, *([ids_col] if ids_col else []), F.explode(slices).alias("_s"))
    ident = (F.element_at(F.col(ids_col), F.col("_s.p") + 1) if ids_col else F.col("_s.p")).cast("long")
    return ex.select(*keep, ident.alias("id"), F.col("_s.v").alias("vector"))
