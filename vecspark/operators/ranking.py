"""Dense positions in a global order without a single-task window.

``row_number()`` over an unpartitioned window moves every row into one
task.  Here the rows are range-partitioned on the order keys, numbered in
place inside each partition, and shifted by the row counts of the earlier
partitions (a table with one row per partition and group in it, broadcast
where it fits the budget).  Rows
of equal or NULL keys are ordered by a hash of the whole row, which is also
part of the range bounds, so a key shared by very many rows is split too;
nothing is joined back on the keys, so no row is ever multiplied or lost.

The numbering depends on range bounds sampled from the input, and an input
that comes out of a shuffle can be sampled differently each time it is
computed; so the numbered rows are written once (a reliable checkpoint in
the shared checkpoint folder) and both the counts and the numbering read
that copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecspark.operators.nearest import sized_broadcast
from vecspark.session import checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition index << 33 | row in partition


def with_positions(df: DataFrame, order_cols, group_cols=(), name: str = "_pos",
                   num_partitions: int | None = None, groups: int | None = None) -> DataFrame:
    """``df`` with ``name``: the row's 0-based position in ``order_cols`` order within its group.

    ``groups`` is a known bound of the groups; a group is a range of partitions,
    so there are at most partitions + groups offsets, which are then not counted.
    """
    order_cols, group_cols = list(order_cols), list(group_cols)
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    checkpoint_dir(spark)
    columns = df.columns
    keys = [*group_cols, *order_cols, "_tie"]
    tagged = (df.withColumn("_tie", F.xxhash64(*columns))
              .repartitionByRange(num_partitions, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True)
              .withColumn("_part", F.shiftright("_mid", _LOCAL_BITS))
              .withColumn("_local", F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)))
    counts = tagged.groupBy("_part", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_local").alias("_first"))
    w = Window.partitionBy(*group_cols).orderBy("_part") if group_cols else Window.orderBy("_part")
    offsets = counts.select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)], "_first",
        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group_cols):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    bound = num_partitions + (groups or 0) if groups is not None or not group_cols else None
    joined = tagged.join(sized_broadcast(offsets, bound), same)
    return joined.select(*columns, (F.col("_offset") + F.col("_local") - F.col("_first")).alias(name))


def positions(df: DataFrame, order_cols, group_cols=(), name: str = "_pos",
              num_partitions: int | None = None, groups: int | None = None) -> DataFrame:
    """``group_cols + order_cols + [name]`` of every row."""
    return with_positions(df.select(*group_cols, *order_cols), order_cols, group_cols, name, num_partitions, groups)
