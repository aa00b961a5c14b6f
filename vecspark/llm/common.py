"""Shared helpers: inputs, written intermediate tables, Arrow columns."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.session import checkpoint_dir, ensure_importable
from vecspark.sources.tables import read_table

__all__ = ["table", "stored", "scratch_path", "texts_of", "parts_of", "string_list", "summed", "finite_vectors", "matrix",
           "ensure_importable"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_importable(spark)
    return read_table(spark, sf_dir, name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage: a lost executor never repeats the work behind it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x if x is not None else b"" for x in col.cast(pa.binary()).to_pylist()]


def parts_of(items: list[bytes], limit: int):
    """Slices ``(first, end)`` of consecutive items of about ``limit`` bytes;
    a longer item makes a slice of its own."""
    first, size = 0, 0
    for i, x in enumerate(items):
        if size and size + len(x) > limit:
            yield first, i
            first, size = i, 0
        size += len(x)
    if first < len(items):
        yield first, len(items)


def string_list(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


#: Partial sums are added in two levels; at most this many rows reach the driver.
SUM_GROUPS = 256


def summed(partials: DataFrame) -> np.ndarray | None:
    """Element-wise sum of the ``v`` arrays (BIGINT or DOUBLE, all of one length), one per task; None without rows.

    Each task's array is added to those of its group on Spark, and at most
    ``SUM_GROUPS`` arrays reach the driver, however many tasks there were.
    Whole numbers come back as Python integers, so that level cannot overflow.
    """
    kind = partials.schema["v"].dataType.elementType.simpleString()

    def add(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                own = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1).sum(0)
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total])], names=["v"])

    grouped = partials.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(SUM_GROUPS))).repartition("g").select("v")
    rows = [r["v"] for r in grouped.mapInArrow(add, f"v array<{kind}>").collect()]
    if not rows:
        return None
    return np.array(rows, dtype=object if kind == "bigint" else np.float64).sum(0)


def finite_vectors(vectors: DataFrame, vector_col: str, keep: list[str]) -> DataFrame:
    """``row`` (a struct of the kept columns) and ``vector`` (doubles) of rows whose vector is whole and finite."""
    rows = vectors.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)


def matrix(col: pa.Array) -> np.ndarray:
    """List column of equal lengths as a matrix."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)
