"""Index lifecycle: create, set options, train, add, reset, build, key, save, load.

Each function returns a new ``VectorIndex``; the tables are DataFrames, so
a build is a plan until something is written or searched.  ``save_index``
writes the tables as Parquet (postings range-partitioned on
``(shard_id, list_id, id)``, written in ``shard_id`` folders and sorted by
``list_id`` inside files, in small row groups, so shard filters prune folders
and list filters skip row groups); ``load_index`` reads them back lazily.

The postings of a stored index are immutable segments, each with statistics
by list.  A manifest names the segments of a version; it is one small file
whose rename makes the version visible.  ``append_to_index`` writes a segment
and then a manifest, so a failed append leaves the version before it as it
was; ``compact_index`` writes small segments as one.  One writer at a time.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.model import (CENTROIDS_SCHEMA, CODEBOOKS_SCHEMA, VECTOR_TYPE, IndexSpec, SearchOptions,
                            VectorIndex, checked_vector, warn)
from vecspark.operators import kmeans as km
from vecspark.operators import pq
from vecspark.operators.nearest import sized_broadcast
from vecspark.operators.ranking import with_positions


def payload_columns(spec: IndexSpec) -> list[str]:
    """Stored columns besides the keys: ``vector``, ``code``, or both (refine)."""
    if spec.kind != "ivf_pq":
        return ["vector"]
    return ["code", "vector"] if spec.refine else ["code"]


def _postings_schema(spec: IndexSpec) -> T.StructType:
    types = {"code": pq.CODE_TYPE, "vector": VECTOR_TYPE}
    return T.StructType([
        T.StructField("shard_id", T.IntegerType(), False),
        T.StructField("list_id", T.IntegerType(), False),
        T.StructField("id", T.LongType(), False),
    ] + [T.StructField(c, types[c], False) for c in payload_columns(spec)])


def create_index(spark: SparkSession, dim: int, kind: str = "flat", metric="l2", *, nlist: int = 1,
                 m: int | None = None, ks: int = 256, iterations: int = 10, refine: bool = False,
                 options: SearchOptions | None = None) -> VectorIndex:
    """An empty index of the given kind (V4)."""
    spec = IndexSpec(dim=dim, kind=kind, metric=metric, nlist=nlist, m=m, ks=ks, iterations=iterations,
                     refine=refine)
    return VectorIndex(spark=spark, spec=spec, options=options or SearchOptions(),
                       postings=spark.createDataFrame([], _postings_schema(spec)),
                       trained=not spec.needs_training, extra={"empty": True})


def _changed(index: VectorIndex, **extra) -> dict:
    """``extra`` of a modified index: stored keys, and what was collected of it, no longer describe it."""
    out = {k: v for k, v in index.extra.items() if k not in ("keys", "memo")}
    out.update(extra)
    return out


def set_options(index: VectorIndex, **options) -> VectorIndex:
    """Store search-time settings (V7): ``nprobe``, ``rerank``; unknown names raise."""
    return index.replace(options=index.options.updated(**options), extra=_changed(index))


def reset_index(index: VectorIndex) -> VectorIndex:
    """Drop the stored vectors (V8); lists, codebooks and options are kept."""
    return index.replace(postings=index.spark.createDataFrame([], _postings_schema(index.spec)),
                         tag_columns=(), extra=_changed(index, empty=True))


_SHARD_TYPES = (T.ByteType, T.ShortType, T.IntegerType)


def _shard_column(df: DataFrame, shard, index: VectorIndex | None = None) -> tuple[DataFrame, bool, DataFrame | None]:
    """``df`` with ``shard_id``, whether it is sharded, and the key table of a coded shard key.

    An INT (or narrower) key is the shard id itself and must not be NULL.
    Any other key is coded: its distinct values, NULL among them, are
    numbered in order (a table of one row per shard, written once); values
    an index does not know yet are numbered on.
    """
    if shard is None:
        if index is not None and index.sharded:
            raise ValueError("the index is sharded: give the shard of the vectors")
        return df.withColumn("shard_id", F.lit(0)), False, None
    expr = F.col(shard) if isinstance(shard, str) else shard
    keyed = df.withColumn("_shard_key", expr)
    if isinstance(keyed.schema["_shard_key"].dataType, _SHARD_TYPES):
        checked = F.when(F.col("_shard_key").isNull(), F.raise_error(F.lit("an integer shard key must not be NULL")))
        return keyed.withColumn("shard_id", checked.otherwise(F.col("_shard_key").cast("int"))).drop("_shard_key"), True, None
    known = index.extra.get("shards") if index is not None else None
    seen = keyed.select(F.col("_shard_key").alias("shard")).distinct()
    first = 0
    if known is not None:
        k = known.select(F.col("shard").alias("_k"), F.col("shard_id").alias("_kid"))
        seen = seen.join(sized_broadcast(k), seen["shard"].eqNullSafe(F.col("_k")), "left_anti")
        first = (known.agg(F.max("shard_id")).first()[0] or 0) + 1
    numbered = with_positions(seen, ["shard"], name="_n").select(
        (F.col("_n") + F.lit(first)).cast("int").alias("shard_id"), "shard")
    table = numbered if known is None else known.unionByName(numbered)
    t = table.select(F.col("shard").alias("_k"), "shard_id")
    joined = keyed.join(sized_broadcast(t), F.col("_shard_key").eqNullSafe(F.col("_k")), "left").drop("_shard_key", "_k")
    return joined, True, table


def shard_labels(index: VectorIndex) -> DataFrame | None:
    """``shard_id, shard`` of an index whose shard key is coded, else None (the key is the id)."""
    return index.extra.get("shards")


def _vectors(df: DataFrame, index: VectorIndex, id_col, vector_col, shard, order_col=None,
             numbered_from: DataFrame | None = None, tags=(), finite: bool = False):
    """(shard_id, id, vector, tags...) with validated vectors and ids, whether sharded, and the shard key table.

    Without ids, each shard's vectors are numbered in ``order_col`` order, from
    0 or on from the shard's count in ``numbered_from`` (shard_id, n).
    """
    df, sharded, table = _shard_column(df, shard, index)
    vec = checked_vector(vector_col, index.dim)
    if id_col is None:
        if order_col is None:
            raise ValueError("vectors without ids need an order column: ids are assigned 0, 1, 2, ... in that order")
        out = with_positions(df.select("shard_id", F.col(order_col).alias("_ord"), F.col(vector_col).alias("_vin"),
                                       *tags), ["_ord"], ["shard_id"])
        start = F.lit(0).cast("long")
        if numbered_from is not None:
            out = out.join(sized_broadcast(numbered_from), "shard_id", "left")
            start = F.coalesce("n", F.lit(0).cast("long"))
        out = out.select("shard_id", (F.col("_pos") + start).alias("id"),
                         checked_vector("_vin", index.dim).alias("vector"), *tags)
    else:
        ident = F.col(id_col)
        out = df.select("shard_id", F.when(ident.isNull(), F.raise_error(F.lit("vector ids must not be NULL")))
                        .otherwise(ident.cast("long")).alias("id"), vec.alias("vector"), *tags)
    if finite:
        bad = F.exists("vector", lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
        out = out.withColumn("vector", F.when(bad, F.raise_error(F.lit(
            "a vector with NaN or infinite components cannot be assigned to a list"))).otherwise(F.col("vector")))
    return out, sharded, table


def _shard_count(df: DataFrame) -> int:
    return df.select("shard_id").distinct().count()


def train_index(index: VectorIndex, df: DataFrame, *, vector_col: str = "vector", id_col: str = "id",
                order_col: str | None = None, shard=None) -> VectorIndex:
    """Learn the lists (and PQ codebooks) from training vectors (V5).

    Every row of ``df`` is used; to train on fewer vectors than are added,
    pass that table.  ``id_col`` (or, without ids, ``order_col``) fixes the
    order used to pick the initial centroids.  NaN and infinite components
    are errors.  A flat index needs no training: warning, unchanged.
    """
    spec = index.spec
    if not spec.needs_training:
        warn("index of kind 'flat' needs no training; unchanged")
        return index
    if index.trained:
        warn("index is already trained; unchanged")
        return index
    rows, sharded, table = _vectors(df, index, id_col, vector_col, shard, order_col, finite=True)
    train = rows.select("shard_id", F.col("id").alias("_id"), F.col("vector").alias("_v"))
    groups = _shard_count(train) if sharded else 1
    cents = km.kmeans(train, dim=spec.dim, nlist=spec.nlist, iterations=spec.iterations, metric=spec.metric,
                      group_keys=["shard_id"], groups=groups)
    books = None
    if spec.kind == "ivf_pq":
        assigned = km.assign_lists(train, cents, dim=spec.dim, metric=spec.metric, group_keys=["shard_id"],
                                   centroid_rows=groups * spec.nlist)
        books = pq.train_codebooks(assigned, cents, m=spec.m, dsub=spec.dsub, ks=spec.ks,
                                   iterations=spec.iterations, groups=groups)
    return index.replace(centroids=cents, codebooks=books, trained=True, sharded=index.sharded or sharded,
                         extra=_changed(index, groups=groups, **({} if table is None else {"shards": table})))


def add_vectors(index: VectorIndex, df: DataFrame, *, vector_col: str = "vector", id_col: str | None = "id",
                order_col: str | None = None, shard=None, tag_columns=()) -> VectorIndex:
    """Append vectors (V6) with their ids, or, when ``id_col`` is None, numbered in ``order_col`` order.

    Numbers go on from each shard's own count, as every shard is an index of
    its own.  Rows of equal or NULL order keys are all kept, each with its number.

    Tag columns are stored next to the vectors for filtered search.
    """
    new, sharded, table = _new_postings(index, df, vector_col, id_col, order_col, shard, tuple(tag_columns))
    postings = new if index.extra.get("empty", False) else index.postings.unionByName(new, allowMissingColumns=True)
    return index.replace(postings=postings, tag_columns=tuple(dict.fromkeys(index.tag_columns + tuple(tag_columns))),
                         sharded=index.sharded or sharded,
                         extra=_changed(index, empty=False, **({} if table is None else {"shards": table})))


def _new_postings(index: VectorIndex, df: DataFrame, vector_col, id_col, order_col, shard, tags):
    """Posting rows of new vectors, whether they are sharded, and the key table of a coded shard key."""
    spec = index.spec
    if not index.trained:
        raise ValueError("index must be trained before vectors are added")
    empty = index.extra.get("empty", False)
    counts = None if (id_col is not None or empty) else index.postings.groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n"))
    rows, sharded, table = _vectors(df, index, id_col, vector_col, shard, order_col, counts, tags,
                                    finite=spec.kind != "flat")
    if spec.kind == "flat":
        new = rows.withColumn("list_id", F.lit(0))
    else:
        groups = index.extra.get("groups", 1)
        assigned = km.assign_lists(rows.withColumn("_v", F.col("vector")), index.centroids, dim=spec.dim,
                                   metric=spec.metric, group_keys=["shard_id"], id_col="id",
                                   centroid_rows=groups * spec.nlist).drop("_v")
        assigned = assigned.withColumn("list_id", F.when(F.col("list_id").isNull(), F.raise_error(
            F.lit("vector belongs to a shard the index was not trained for"))).otherwise(F.col("list_id")))
        if spec.kind == "ivf_pq":
            keep = (("vector",) if spec.refine else ()) + tags
            new = pq.encode(assigned, index.centroids, index.codebooks, m=spec.m, dsub=spec.dsub, ks=spec.ks,
                            groups=groups, nlist=spec.nlist, keep=keep)
        else:
            new = assigned
    cols = ["shard_id", "list_id", "id", *payload_columns(spec), *tags]
    return new.select(*cols), sharded, table


def build_index(df: DataFrame, dim: int, kind: str = "flat", metric="l2", *, nlist: int = 1,
                m: int | None = None, ks: int = 256, iterations: int = 10, refine: bool = False,
                vector_col: str = "vector", id_col: str | None = "id", order_col: str | None = None, shard=None,
                tag_columns=(), **options) -> VectorIndex:
    """create + set options + train + add in one call (V9); ``shard`` builds one index per shard (V10).

    Without ids (``id_col=None``) vectors are numbered per shard in ``order_col`` order.
    """
    idx = create_index(df.sparkSession, dim, kind, metric, nlist=nlist, m=m, ks=ks, iterations=iterations,
                       refine=refine)
    if options:
        idx = set_options(idx, **options)
    if idx.spec.needs_training:
        idx = train_index(idx, df, vector_col=vector_col, id_col=id_col, order_col=order_col, shard=shard)
    return add_vectors(idx, df, vector_col=vector_col, id_col=id_col, order_col=order_col, shard=shard,
                       tag_columns=tag_columns)


_SUMS = {1: "sum1", 2: "sum2"}


def _content(df: DataFrame, by: list[str], columns) -> DataFrame:
    """``by, n, sum1, sum2``: row count and two independent order-free sums of row hashes.

    Sums, unlike exclusive-or, keep repeated rows apart; DECIMAL(38) cannot
    overflow below 10**18 rows.  Null columns do not enter a hash.
    """
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)")).cast("decimal(38,0)").alias(name)
        for seed, name in _SUMS.items()])


def _added(content: DataFrame) -> DataFrame:
    """``shard_id, part`` of content rows of any number of segments and lists."""
    added = content.groupBy("shard_id").agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in _SUMS.values()])
    return added.select("shard_id", F.concat_ws("|", F.col("n").cast("string"), *[F.col(c).cast("string") for c in _SUMS.values()])
                        .alias("part"))


def _posting_columns(spec: IndexSpec, tags) -> list[str]:
    return ["list_id", "id", *payload_columns(spec), *tags]


def _compute_keys(index: VectorIndex, content: DataFrame | None = None) -> DataFrame:
    """Keys of the shards; ``content`` is that of the postings where it is stored."""
    spec = index.spec
    desc = json.dumps({"spec": spec.__dict__, "options": index.options.as_map(), "tags": list(index.tag_columns)},
                      sort_keys=True)
    if content is None:
        content = _content(index.postings, ["shard_id"], _posting_columns(spec, index.tag_columns))
    keys = _added(content).withColumnRenamed("part", "_p0")
    parts = ["_p0"]
    for name, df, columns in (("_p1", index.centroids, ["list_id", "centroid"]),
                              ("_p2", index.codebooks, ["sub", "code", "centroid"])):
        if df is not None:
            keys = keys.join(_added(_content(df, ["shard_id"], columns)).withColumnRenamed("part", name), "shard_id", "left")
            parts.append(name)
    return keys.select("shard_id", F.md5(F.concat_ws("#", F.lit(desc), F.col("shard_id").cast("string"), *[
        F.coalesce(F.col(p), F.lit("-")) for p in parts])).alias("index_key"))


def index_keys(index: VectorIndex) -> DataFrame:
    """(shard_id, index_key): md5 over spec, options and the contents of postings, tags, centroids and codebooks (V17).

    Uses the keys stored by ``with_keys`` / ``load_index`` when present;
    otherwise this is one aggregate pass over the postings.
    """
    keys = index.extra.get("keys")
    return keys if keys is not None else _compute_keys(index)


def with_keys(index: VectorIndex) -> VectorIndex:
    """Compute the keys once (one pass) and keep them with the index (one row per shard)."""
    tbl = _compute_keys(index).toArrow()
    keys = index.spark.createDataFrame(tbl).select(F.col("shard_id").cast("int"), "index_key")
    return index.replace(extra={**index.extra, "keys": keys})


def shards_of_key(index: VectorIndex, key: str) -> list[int]:
    """Shard ids whose key is ``key`` (one small collect: at most one row per shard)."""
    return [int(r["shard_id"]) for r in index_keys(index).where(F.col("index_key") == F.lit(key))
            .select("shard_id").collect()]


SAVE_TASK_BYTES = 256 << 20
ROW_GROUP_BYTES = 8 << 20  # a probe of a few lists skips the row groups of the others


def _write_segment(index: VectorIndex, postings: DataFrame, path: str, name: str, mode: str = "error") -> dict:
    """Write posting rows as a segment with its statistics by list; returns its manifest entry."""
    spec, spark = index.spec, index.spark
    # Range partitioning on (shard, list, id) keeps tasks balanced even when one
    # shard or list holds a large share of the rows, and leaves every file
    # sorted by list.  The number of tasks follows the counted size.
    row_bytes = 32 + (4 * spec.dim if "vector" in payload_columns(spec) else 0) + (spec.m or 0)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")), -(-postings.count() * row_bytes // SAVE_TASK_BYTES))
    (postings.repartitionByRange(n, "shard_id", "list_id", "id")
     .sortWithinPartitions("shard_id", "list_id", "id")
     .write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES).partitionBy("shard_id").parquet(os.path.join(path, "postings", f"segment={name}")))
    tags = [c for c in postings.columns if c in index.tag_columns]
    # Of the rows as written, read back rather than computed again from their lineage.
    written = _segments(spark, path, [name], postings.schema)
    stats = _content(written, ["shard_id", "list_id"], _posting_columns(spec, tags))
    stats.write.mode(mode).parquet(os.path.join(path, "stats", name))
    rows = spark.read.schema(stats.schema).parquet(os.path.join(path, "stats", name)).agg(F.sum("n")).first()[0] or 0
    return {"name": name, "rows": int(rows)}


def _commit(spark: SparkSession, path: str, manifest: dict) -> None:
    """Make a version visible: one file, moved into its place when it is whole."""
    where = os.path.join(path, "manifests", f"{manifest['epoch']}-{manifest['version']:08d}")
    spark.createDataFrame([(json.dumps(manifest),)], "manifest string").coalesce(1).write.mode("error").text(where)


def _manifest(spark: SparkSession, path: str, epoch: str, version: int | None = None) -> dict:
    rows = spark.read.text(os.path.join(path, "manifests", f"{epoch}-*")).collect()  # one short row a version
    known = {m["version"]: m for m in (json.loads(r["value"]) for r in rows)}
    if version is not None and version not in known:
        raise ValueError(f"the stored index has no version {version}")
    return known[max(known) if version is None else version]


def save_index(index: VectorIndex, path: str, mode: str = "error") -> None:
    spec, spark = index.spec, index.spark
    epoch = uuid.uuid4().hex  # manifests of an index that this one replaces do not count
    meta = {"spec": spec.__dict__, "options": {"nprobe": index.options.nprobe, "rerank": index.options.rerank},
            "trained": index.trained, "groups": index.extra.get("groups", 1), "epoch": epoch}
    if index.centroids is not None:
        index.centroids.write.mode(mode).parquet(os.path.join(path, "centroids"))
    if index.codebooks is not None:
        index.codebooks.write.mode(mode).parquet(os.path.join(path, "codebooks"))
    segment = _write_segment(index, index.postings, path, "s0", mode)
    shards = None
    if "shards" in index.extra:
        shards = "shards"
        index.extra["shards"].write.mode(mode).parquet(os.path.join(path, shards))
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(mode).json(os.path.join(path, "meta"))
    _commit(spark, path, {"epoch": epoch, "version": 0, "segments": [segment], "sharded": index.sharded, "shards": shards,
                          "tags": list(index.tag_columns), "schema": index.postings.schema.jsonValue()})


def load_index(spark: SparkSession, path: str, version: int | None = None) -> VectorIndex:
    """The stored index, in its latest version or in one of those before."""
    return _opened(spark, path, version)[0]


def _opened(spark: SparkSession, path: str, version: int | None = None) -> tuple[VectorIndex, dict]:
    meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
    manifest = _manifest(spark, path, meta["epoch"], version)
    spec = IndexSpec(**meta["spec"])
    names = [s["name"] for s in manifest["segments"]]
    postings = _segments(spark, path, names, T.StructType.fromJson(manifest["schema"]))
    cents = spark.read.schema(CENTROIDS_SCHEMA).parquet(os.path.join(path, "centroids")) \
        if spec.needs_training else None
    books = spark.read.schema(CODEBOOKS_SCHEMA).parquet(os.path.join(path, "codebooks")) \
        if spec.kind == "ivf_pq" else None
    opts = SearchOptions(**{k: v for k, v in meta["options"].items() if v is not None})
    extra = {"groups": meta["groups"], "empty": False, "memo": {}}
    if manifest["shards"]:
        extra["shards"] = spark.read.parquet(os.path.join(path, manifest["shards"]))
    index = VectorIndex(spark=spark, spec=spec, options=opts, postings=postings, centroids=cents, codebooks=books,
                        tag_columns=tuple(manifest["tags"]), sharded=manifest["sharded"], trained=meta["trained"], extra=extra)
    content = spark.read.parquet(*[os.path.join(path, "stats", n) for n in names])
    return index.replace(extra={**extra, "keys": _compute_keys(index, content)}), manifest


def _segments(spark: SparkSession, path: str, names: list[str], schema: T.StructType) -> DataFrame:
    """The rows of segments; a tag column that a segment lacks is NULL there."""
    root = os.path.join(path, "postings")
    return (spark.read.option("basePath", root).schema(T.StructType([*schema.fields, T.StructField("segment", T.StringType())]))
            .parquet(*[os.path.join(root, f"segment={n}") for n in names]).select(*schema.names))


def append_to_index(spark: SparkSession, path: str, df: DataFrame, *, vector_col: str = "vector", id_col: str | None = "id",
                    order_col: str | None = None, shard=None, tag_columns=()) -> int:
    """Add vectors to a stored index as one more segment; returns the new version.

    As ``add_vectors``, but what is stored already is not written again, nor
    read (but for its counts by shard where vectors without ids are numbered).
    """
    index, old = _opened(spark, path)
    tags = tuple(tag_columns)
    new, sharded, table = _new_postings(index, df, vector_col, id_col, order_col, shard, tags)
    fields = T.StructType.fromJson(old["schema"]).fields
    schema = T.StructType(fields + [new.schema[t] for t in tags if t not in old["tags"]])
    index = index.replace(tag_columns=tuple(dict.fromkeys(index.tag_columns + tags)))
    name = f"s{uuid.uuid4().hex}"
    segment = _write_segment(index, new, path, name)
    shards = old["shards"]
    if table is not None:
        shards = f"shards-{name}"
        table.write.parquet(os.path.join(path, shards))
    _commit(spark, path, {**old, "version": old["version"] + 1, "segments": old["segments"] + [segment], "shards": shards,
                          "sharded": index.sharded or sharded, "tags": list(index.tag_columns), "schema": schema.jsonValue()})
    return old["version"] + 1


def compact_index(spark: SparkSession, path: str, small_rows: int = 1 << 20) -> int:
    """Write the segments of fewer than ``small_rows`` rows as one; returns the version in force.

    Versions before it keep their files.
    """
    index, old = _opened(spark, path)
    small = [s for s in old["segments"] if s["rows"] < small_rows]
    if len(small) < 2:
        return old["version"]
    rows = _segments(spark, path, [s["name"] for s in small], T.StructType.fromJson(old["schema"]))
    merged = _write_segment(index, rows, path, f"s{uuid.uuid4().hex}")
    kept = [s for s in old["segments"] if s not in small]
    _commit(spark, path, {**old, "version": old["version"] + 1, "segments": kept + [merged]})
    return old["version"] + 1


def count_vectors(index: VectorIndex) -> int:
    return index.postings.count()


