"""Inputs: the driver's Parquet tables and the reference's test fixtures.

``embeddings(spark, sf_dir)`` is the vector table of the test data
(``vec_id, embedding, label``) renamed to the library's default column
names ``id, vector, label``.  The fixture generators rebuild the inputs of
the reference's regression script with ``spark.range`` (whose end is
exclusive; the script's ``generate_series`` end is inclusive).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id LONG, vector ARRAY<FLOAT>, label INT`` from the embeddings table."""
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label"))


def ramp(id_col, offset: float = 0.0, width: int = 10):
    """Vector ``id + offset, id + 1 + offset, ... `` of ``width`` floats."""
    return F.transform(F.sequence(F.col(id_col), F.col(id_col) + (width - 1)),
                       lambda x: x.cast("float") + F.lit(offset).cast("float"))


def vector_queried(spark: SparkSession) -> DataFrame:
    """10,000 vectors: id = 0, 10, ..., 99990; vector = id ... id+9."""
    return spark.range(0, 100000, 10).select(F.col("id"), ramp("id").alias("vector"))


def vector_query(spark: SparkSession) -> DataFrame:
    """10 queries: id = 0, 10005, ..., 90045; vector = id+0.5 ... id+9.5."""
    return spark.range(0, 100000, 10005).select(F.col("id"), ramp("id", 0.5).alias("vector"))


def small_pack_input(spark: SparkSession) -> DataFrame:
    """10 vectors: id = 0, 10, ..., 90; vector = id ... id+9."""
    return spark.range(0, 100, 10).select(F.col("id"), ramp("id").alias("vector"))


def training_ramp(spark: SparkSession, n_values: int = 2560) -> DataFrame:
    """One packed row of 1 ... n_values (the IVF-PQ training input)."""
    return spark.range(1).select(
        F.transform(F.sequence(F.lit(1), F.lit(n_values)), lambda x: x.cast("float")).alias("vectors"))


def merge_input(spark: SparkSession) -> DataFrame:
    """4 lists: id = 0, 3, 6, 9; idxs = id, id+7, ..., id+28; distance = idx + 100."""
    seq = F.sequence(F.col("id"), F.col("id") + 30, F.lit(7).cast("long"))
    return spark.range(0, 10, 3).select(
        seq.alias("idxs"), F.transform(seq, lambda x: (x + 100).cast("float")).alias("distances"))
