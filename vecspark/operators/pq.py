"""Product quantization of IVF residuals.

A vector ``v`` in list ``L`` is stored as ``m`` codes: the residual
``v - c_L`` is cut into ``m`` sub-vectors of ``dim/m`` values and each is
replaced by the number of its nearest centroid among ``ks`` centroids of
that sub-space (one codebook per shard and sub-space, trained by the same
k-means as the lists).  The asymmetric distance of a query to a stored
vector is its distance to the reconstruction ``c_L + concat_j C_j[code_j]``.
Codes are stored packed (``functions.codes``) and searched by lookup tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.functions import codes as pc
from vecspark.functions import kernels
from vecspark.session import ensure_importable
from vecspark.operators import kmeans as km
from vecspark.operators import nearest as nn

CODE_TYPE = T.BinaryType()


def residuals(rows: DataFrame, centroids: DataFrame) -> DataFrame:
    """``rows`` (shard_id, list_id, _v, ...) with ``_v`` replaced by ``_v - centroid`` (doubles)."""
    c = centroids.select("shard_id", "list_id", F.col("centroid").alias("_c"))
    return (rows.join(c, ["shard_id", "list_id"])
            .withColumn("_v", F.zip_with(F.col("_v"), F.col("_c"), lambda a, b: a.cast("double") - b))
            .drop("_c"))


def split_subvectors(rows: DataFrame, m: int, dsub: int) -> DataFrame:
    """One row per (row, sub-space): ``sub`` and ``_v`` = that slice."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(m - 1)),
                        lambda j: F.struct(j.alias("sub"), F.slice(F.col("_v"), j * dsub + 1, dsub).alias("_v")))
    return (rows.withColumn("_p", F.explode(parts))
            .withColumn("sub", F.col("_p.sub").cast("int"))
            .withColumn("_v", F.col("_p._v")).drop("_p"))


def train_codebooks(train: DataFrame, centroids: DataFrame, *, m: int, dsub: int, ks: int,
                    iterations: int, groups: int) -> DataFrame:
    """Codebooks (shard_id, sub, code, centroid) from training rows (shard_id, list_id, _id, _v)."""
    subs = split_subvectors(residuals(train, centroids), m, dsub).select("shard_id", "sub", "_id", "_v")
    cb = km.kmeans(subs, dim=dsub, nlist=ks, iterations=iterations, metric="l2",
                   group_keys=["shard_id", "sub"], groups=groups * m)
    return cb.select("shard_id", "sub", F.col("list_id").alias("code"), "centroid")


class _Tables:
    """List centroids and codebooks as matrices with sorted keys, to be gathered for a whole batch at once."""

    def __init__(self, centroids: pa.Table, codebooks: pa.Table, dim: int, m: int, dsub: int, ks: int):
        shard, lst = (centroids.column(c).to_numpy().astype(np.int64) for c in ("shard_id", "list_id"))
        key = (shard << 32) | lst
        order = np.argsort(key)
        self.list_keys = key[order]
        self.lists = kernels.list_matrix(centroids.column("centroid"), dim)[order]
        book_shard, sub, code = (codebooks.column(c).to_numpy().astype(np.int64) for c in ("shard_id", "sub", "code"))
        self.shards, place = np.unique(book_shard, return_inverse=True)
        self.books = np.zeros((len(self.shards), m, ks, dsub))
        self.books[place, sub, code] = kernels.list_matrix(codebooks.column("centroid"), dsub)

    def centroids_of(self, shard: np.ndarray, lst: np.ndarray) -> np.ndarray:
        key = (shard.astype(np.int64) << 32) | lst.astype(np.int64)
        place = np.minimum(np.searchsorted(self.list_keys, key), len(self.list_keys) - 1)
        if not (self.list_keys[place] == key).all():
            raise ValueError("a stored vector's list has no centroid")
        return self.lists[place]

    def reconstruct(self, rb: pa.RecordBatch, m: int) -> np.ndarray:
        """``(rows, dim)`` reconstructions of a batch's ``shard_id, list_id, code``."""
        codes = pc.unpack(pc.stored_words(rb.column("code"), m, self.books.shape[2]), m, self.books.shape[2])
        shard = rb.column("shard_id").to_numpy(zero_copy_only=False)
        lst = rb.column("list_id").to_numpy(zero_copy_only=False)
        parts = self.books[self.books_of(shard)[:, None], np.arange(m)[None, :], codes]  # (n, m, dsub)
        return parts.reshape(len(codes), -1) + self.centroids_of(shard, lst)

    def books_of(self, shard: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.shards, shard)


def _broadcast_tables(spark, centroids: DataFrame, codebooks: DataFrame, *, dim: int, m: int, dsub: int, ks: int):
    """Collect the (size-checked) list centroids and codebooks into NumPy and broadcast them."""
    ct = centroids.select("shard_id", "list_id", "centroid").toArrow()
    cbt = codebooks.select("shard_id", "sub", "code", "centroid").toArrow()
    return spark.sparkContext.broadcast(_Tables(ct, cbt, dim, m, dsub, ks))


def encode(rows: DataFrame, centroids: DataFrame, codebooks: DataFrame, *, m: int, dsub: int, ks: int,
           groups: int, nlist: int, keep=()) -> DataFrame:
    """Rows (shard_id, list_id, id, vector, keep...) -> (shard_id, list_id, id, code, keep...).

    With centroids and codebooks inside the broadcast budget (their size is
    fixed by the spec and the shard count), every batch is encoded in place:
    residual, then the nearest codeword per sub-space (ties to the lower
    code).  Beyond the budget, sub-vectors are exploded, assigned with the
    tiled plan and regrouped per vector.
    """
    keep = list(keep)
    spark = rows.sparkSession
    ensure_importable(spark)
    dim = m * dsub
    if nn.side_bytes(groups * (nlist + m * ks), dim) <= nn.broadcast_budget(spark):
        bc = _broadcast_tables(spark, centroids, codebooks, dim=dim, m=m, dsub=dsub, ks=ks)
        base = rows.select("shard_id", "list_id", "id", F.col("vector").alias("_v"), *keep)
        fields = {f.name: f for f in base.schema.fields}
        out_schema = T.StructType([fields["shard_id"], fields["list_id"], fields["id"],
                                   T.StructField("code", CODE_TYPE, False)] + [fields[c] for c in keep])
        code_ids = np.arange(ks, dtype=np.int64)

        def run(batches):
            tables = bc.value
            preps = {}
            for rb in batches:
                n = rb.num_rows
                if not n:
                    continue
                vecs = kernels.list_matrix(rb.column("_v"), dim)
                shard = rb.column("shard_id").to_numpy(zero_copy_only=False)
                lst = rb.column("list_id").to_numpy(zero_copy_only=False)
                codes = np.zeros((n, m), np.int32)
                res = vecs - tables.centroids_of(shard, lst)
                book_of = tables.books_of(shard)
                for at in np.unique(book_of):  # one kernel call per shard and sub-space, whatever the number of lists
                    rows_ = np.flatnonzero(book_of == at)
                    for j in range(m):
                        book = tables.books[at, j]
                        if (at, j) not in preps:
                            preps[at, j] = kernels.prepare_items(book, "l2")
                        qi, vi, _ = kernels.search_block(res[rows_, j * dsub:(j + 1) * dsub], book, code_ids, "l2",
                                                         k=1, prep=preps[at, j])
                        codes[rows_[qi], j] = vi
                cols = [rb.column("shard_id"), rb.column("list_id"), rb.column("id"), pc.pack(codes, ks)] + [rb.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays(cols, names=["shard_id", "list_id", "id", "code"] + keep)

        return base.mapInArrow(run, out_schema)
    base = rows.select("shard_id", "list_id", "id", F.col("vector").alias("_v"), *keep)
    subs = split_subvectors(residuals(base, centroids), m, dsub)
    cb = codebooks.select("shard_id", "sub", F.col("code").alias("list_id"), "centroid")
    coded = km.assign_lists(subs.withColumnRenamed("list_id", "_list"), cb, dim=dsub, metric="l2",
                            group_keys=["shard_id", "sub"], id_col="id", out_col="_code",
                            centroid_rows=groups * m * ks)
    arrays = (coded.groupBy("shard_id", F.col("_list").alias("list_id"), "id")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("sub", "_code"))), lambda x: x["_code"])
                 .alias("code"), *[F.first(c).alias(c) for c in keep]))

    def packed(batches):
        for rb in batches:
            codes = kernels.list_matrix(rb.column("code"), m).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pc.pack(codes, ks) if c == "code" else rb.column(c) for c in rb.schema.names],
                                             names=rb.schema.names)

    return arrays.mapInArrow(packed, T.StructType([T.StructField("code", CODE_TYPE, False) if f.name == "code" else f
                                                   for f in arrays.schema.fields]))


class CodeSearch:
    """Search of stored codes inside a task (see ``nearest``): tables per (query, list), nothing is reconstructed."""

    columns = ("shard_id", "list_id", "code")

    def __init__(self, tables, m: int, ks: int):
        self.tables, self.m, self.ks = tables, m, ks

    def open(self, rb: pa.RecordBatch) -> np.ndarray:
        return pc.stored_words(rb.column("code"), self.m, self.ks)

    def prepare(self, words, rows, metric):
        return words[rows]

    def search(self, qm, words, ids, group, metric, k, radius, limit=None):
        shard, lst = group
        t = self.tables.value
        return pc.search_codes(qm, words, ids, t.centroids_of(np.array([shard]), np.array([lst]))[0],
                               t.books[t.books_of(np.array([shard]))[0]], metric, k=k, radius=radius)


def code_search(spark, centroids: DataFrame, codebooks: DataFrame, *, dim: int, m: int, dsub: int, ks: int, rows_hint: int,
                memo: dict | None = None) -> CodeSearch | None:
    """A ``CodeSearch``, or None beyond the broadcast budget; ``memo`` keeps the broadcast tables of an index."""
    if nn.side_bytes(rows_hint, dim) > nn.broadcast_budget(spark):
        return None
    memo = {} if memo is None else memo
    if "code_tables" not in memo:
        memo["code_tables"] = _broadcast_tables(spark, centroids, codebooks, dim=dim, m=m, dsub=dsub, ks=ks)
    return CodeSearch(memo["code_tables"], m, ks)


def decode(postings: DataFrame, centroids: DataFrame, codebooks: DataFrame, *, dim: int, m: int,
           dsub: int, ks: int, rows_hint: int) -> DataFrame:
    """Postings with codes -> ``_v`` = reconstruction (doubles), other columns kept.

    Centroids and codebooks are broadcast when they fit the budget and each
    batch is decoded in place; otherwise the codes are joined with the
    codebook table.
    """
    spark = postings.sparkSession
    ensure_importable(spark)
    if nn.side_bytes(rows_hint, dim) <= nn.broadcast_budget(spark):
        bc = _broadcast_tables(spark, centroids, codebooks, dim=dim, m=m, dsub=dsub, ks=ks)
        fields = [f for f in postings.schema.fields if f.name != "code"]
        out_schema = T.StructType(fields + [T.StructField("_v", T.ArrayType(T.DoubleType()), False)])
        names = [f.name for f in fields]

        def run(batches):
            tables = bc.value
            for rb in batches:
                n = rb.num_rows
                if not n:
                    continue
                rec = tables.reconstruct(rb, m)
                arr = pa.FixedSizeListArray.from_arrays(pa.array(rec.reshape(-1)), dim).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([rb.column(c) for c in names] + [arr], names=names + ["_v"])

        return postings.mapInArrow(run, out_schema)
    ex = postings.select("*", F.posexplode(pc.code_array("code", m, ks)).alias("sub", "_cd"))
    cb = codebooks.select("shard_id", "sub", F.col("code").alias("_cd"), F.col("centroid").alias("_part"))
    keys = [c for c in postings.columns if c != "code"]
    parts = (ex.join(cb, ["shard_id", "sub", "_cd"])
             .groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("sub", "_part"))),
                                                        lambda x: x["_part"])).alias("_r")))
    c = centroids.select("shard_id", "list_id", F.col("centroid").alias("_c"))
    return (parts.join(c, ["shard_id", "list_id"])
            .withColumn("_v", F.zip_with("_r", "_c", lambda a, b: a + b)).drop("_r", "_c"))
