"""Index description, search options and the index value.

An index is not a blob: it is a small spec plus DataFrames (the tables
below).  Every modifier returns a new ``VectorIndex``; inputs are never
changed, as in the reference where each function returns a new value.

    centroids  (shard_id INT, list_id INT, centroid ARRAY<DOUBLE>)        ivf_*
    codebooks  (shard_id INT, sub INT, code INT, centroid ARRAY<DOUBLE>)  ivf_pq
    postings   (shard_id INT, list_id INT, id LONG, vector ARRAY<FLOAT>, <tags>)   flat / ivf_flat
               (shard_id INT, list_id INT, id LONG, code BINARY, <tags>)           ivf_pq
"""

from __future__ import annotations

import dataclasses
import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metric numbers of the index library's public metric list.
METRIC_NUMBERS = {"ip": 0, "l2": 1, "l1": 2, "linf": 3}
METRICS = tuple(METRIC_NUMBERS)
KINDS = ("flat", "ivf_flat", "ivf_pq")

VECTOR_TYPE = T.ArrayType(T.FloatType())
CENTROID_TYPE = T.ArrayType(T.DoubleType())

CENTROIDS_SCHEMA = T.StructType([
    T.StructField("shard_id", T.IntegerType(), False),
    T.StructField("list_id", T.IntegerType(), False),
    T.StructField("centroid", CENTROID_TYPE, False),
])
CODEBOOKS_SCHEMA = T.StructType([
    T.StructField("shard_id", T.IntegerType(), False),
    T.StructField("sub", T.IntegerType(), False),
    T.StructField("code", T.IntegerType(), False),
    T.StructField("centroid", CENTROID_TYPE, False),
])


def metric_name(metric) -> str:
    if isinstance(metric, int):
        for name, num in METRIC_NUMBERS.items():
            if num == metric:
                return name
        raise ValueError(f"unsupported metric number {metric}")
    m = str(metric).lower()
    if m not in METRIC_NUMBERS:
        raise ValueError(f"unsupported metric {metric!r}; use one of {METRICS}")
    return m


def positive_int(name: str, value) -> int:
    if value is None:
        raise ValueError(f"{name} is required")
    if isinstance(value, bool) or int(value) != value or int(value) <= 0:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")
    return int(value)


@dataclass(frozen=True)
class IndexSpec:
    """What kind of index: replaces the reference's description string.

    kind      'flat' (exact), 'ivf_flat' (inverted lists), 'ivf_pq'
              (inverted lists over product-quantized residuals)
    nlist     number of k-means lists per shard (ivf_*)
    m, ks     PQ: sub-vectors per vector and centroids per sub-space
    iterations  Lloyd iterations for every k-means of the index
    refine    ivf_pq: also keep the raw vectors, so a search can re-rank
              its PQ candidates exactly (option ``rerank``)
    """

    dim: int
    kind: str = "flat"
    metric: str = "l2"
    nlist: int = 1
    m: int | None = None
    ks: int = 256
    iterations: int = 10
    refine: bool = False

    def __post_init__(self):
        object.__setattr__(self, "dim", positive_int("dim", self.dim))
        object.__setattr__(self, "metric", metric_name(self.metric))
        if self.kind not in KINDS:
            raise ValueError(f"unknown index kind {self.kind!r}; use one of {KINDS}")
        object.__setattr__(self, "nlist", positive_int("nlist", self.nlist))
        object.__setattr__(self, "iterations", positive_int("iterations", self.iterations))
        if self.kind == "ivf_pq":
            m = positive_int("m", self.m)
            if self.dim % m:
                raise ValueError(f"dim {self.dim} is not divisible by m {m}")
            object.__setattr__(self, "ks", positive_int("ks", self.ks))
        if self.kind == "flat" and self.nlist != 1:
            raise ValueError("a flat index has exactly one list")
        if self.refine and self.kind != "ivf_pq":
            raise ValueError("refine applies to ivf_pq indexes only")

    @property
    def needs_training(self) -> bool:
        return self.kind != "flat"

    @property
    def dsub(self) -> int:
        return self.dim // self.m


# The search-time settings an index accepts.
OPTION_NAMES = ("nprobe", "rerank")


@dataclass(frozen=True)
class SearchOptions:
    """Search-time settings stored with the index (the runtime parameters).

    nprobe  lists probed per query and shard (ivf_*); default 1
    rerank  ivf_pq: re-rank this many PQ candidates per query with the
            exact vectors (None = no re-ranking)
    """

    nprobe: int = 1
    rerank: int | None = None

    def updated(self, **kw) -> "SearchOptions":
        unknown = set(kw) - set(OPTION_NAMES)
        if unknown:
            raise ValueError(f"unknown search option(s) {sorted(unknown)}; known: {OPTION_NAMES}")
        out = dataclasses.replace(self, **kw)
        positive_int("nprobe", out.nprobe)
        if out.rerank is not None:
            positive_int("rerank", out.rerank)
        return out

    def as_map(self) -> dict[str, str]:
        return {k: str(getattr(self, k)) for k in OPTION_NAMES if getattr(self, k) is not None}


@dataclass(frozen=True)
class VectorIndex:
    """An index value: spec, options and its tables (DataFrames)."""

    spark: SparkSession
    spec: IndexSpec
    options: SearchOptions
    postings: DataFrame
    centroids: DataFrame | None = None
    codebooks: DataFrame | None = None
    tag_columns: tuple[str, ...] = ()
    sharded: bool = False
    trained: bool = False
    extra: dict = field(default_factory=dict)

    def replace(self, **kw) -> "VectorIndex":
        return dataclasses.replace(self, **kw)

    @property
    def dim(self) -> int:
        return self.spec.dim

    @property
    def metric(self) -> str:
        return self.spec.metric


def checked_vector(col: Column | str, dim: int, what: str = "vector") -> Column:
    """The vector column, or a task error if it is NULL, holds NULLs or has the wrong size.

    ``zip_with`` and friends silently pad unequal arrays with NULL, so the
    size check is mandatory before any distance is computed.
    """
    c = F.col(col) if isinstance(col, str) else col
    bad = c.isNull() | (F.size(c) != F.lit(dim)) | F.exists(c, lambda x: x.isNull())
    return F.when(bad, F.raise_error(F.lit(f"{what} must be a non-NULL array of {dim} non-NULL values"))).otherwise(
        c.cast(VECTOR_TYPE))


def warn(msg: str):
    warnings.warn(msg, stacklevel=3)
