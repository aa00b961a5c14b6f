"""Merge partial top-k lists into one top-k list per group (V19).

Input rows carry ``idxs ARRAY<LONG>`` and ``distances ARRAY<FLOAT>`` of equal
length (e.g. one row per shard's local result).  The lists are exploded,
ranked with ``row_number() <= k`` (planned as a partial ``WindowGroupLimit``
before the exchange, so each task ships at most k rows per group) and
re-packed.  Rows with empty lists are skipped; a group with nothing left
gives NULL, as in the reference; NULL lists and NULL elements are errors.  Inputs need not be sorted.  Duplicate ids
are kept.  Ties are broken by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.model import positive_int


def explode_lists(df: DataFrame, *, by=(), idxs_col: str = "idxs", distances_col: str = "distances",
                  keep_empty: bool = False) -> DataFrame:
    """One row per list entry; ``keep_empty`` leaves one NULL row for an empty list (so its group survives)."""
    by = list(by)
    i, d = F.col(idxs_col), F.col(distances_col)
    bad = (i.isNull() | d.isNull() | (F.size(i) != F.size(d))
           | F.exists(i, lambda x: x.isNull()) | F.exists(d, lambda x: x.isNull()))
    checked = F.when(bad, F.raise_error(F.lit(
        "topk_merge: idxs and distances must be non-NULL, without NULL elements and of equal length"))) \
        .otherwise(F.arrays_zip(i.alias("idx"), d.alias("distance")))
    explode = F.explode_outer if keep_empty else F.explode
    return df.select(*by, explode(checked).alias("_e")).select(
        *by, F.col("_e.idx").cast("long").alias("idx"), F.col("_e.distance").alias("distance"))


def topk_merge(df: DataFrame, k: int, *, by=(), idxs_col: str = "idxs", distances_col: str = "distances",
               larger_is_nearer: bool = False) -> DataFrame:
    """``by..., idxs, distances``: the best k of all the group's lists, nearest first.

    One window and one aggregate: empty lists leave a NULL marker row (ranked
    last), so a group whose lists are all empty still appears, with NULL.
    """
    k = positive_int("k", k)
    by = list(by)
    ex = explode_lists(df, by=by, idxs_col=idxs_col, distances_col=distances_col, keep_empty=True)
    order = F.col("distance").desc_nulls_last() if larger_is_nearer else F.col("distance").asc_nulls_last()
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(order, F.col("idx").asc_nulls_last())
    ranked = ex.withColumn("ranking", F.row_number().over(w)).where(F.col("ranking") <= k)
    entry = F.when(F.col("idx").isNotNull(), F.struct("ranking", "idx", "distance"))
    agg = ranked.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("_s"))
    empty = F.size("_s") == 0
    elem = df.schema[distances_col].dataType.elementType
    return agg.select(*by,
                      F.when(~empty, F.transform("_s", lambda x: x["idx"])).cast(T.ArrayType(T.LongType()))
                      .alias("idxs"),
                      F.when(~empty, F.transform("_s", lambda x: x["distance"])).cast(T.ArrayType(elem))
                      .alias("distances"))


def rank_lists(df: DataFrame, k: int, *, by=(), idxs_col: str = "idxs", distances_col: str = "distances",
               larger_is_nearer: bool = False) -> DataFrame:
    """Long form of the merge: ``by..., idx, distance, ranking`` (ranking 1..k)."""
    by = list(by)
    ex = explode_lists(df, by=by, idxs_col=idxs_col, distances_col=distances_col)
    order = F.col("distance").desc() if larger_is_nearer else F.col("distance").asc()
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(order, F.col("idx").asc())
    return ex.withColumn("ranking", F.row_number().over(w).cast("long")).where(F.col("ranking") <= k)
