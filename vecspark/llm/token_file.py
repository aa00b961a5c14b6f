"""Token-ID output: Huffman-coded blocks in ascending document order.

Writing takes two passes.  The first tokenises every whole text, stores the
ids in the shared folder and, in the same pass, counts them per task; the
counts are summed by id and give one canonical code of limited length
(at most vocabulary-size rows reach the driver).  The second pass sorts the
documents by range and writes blocks.

A token file is a folder of Parquet tables:

* ``codes``: ``id, length``, the canonical code's word lengths;
* ``blocks``: a row per block of whole documents, of about ``BLOCK`` ids:
  ``part``, ``block``, ``first`` (ids of the part before it), ``doc_ids``,
  ``doc_lengths``, ``offsets`` (bit offset of each 256th id, so reading can
  start there), ``payload`` (the bits).  Parts and blocks ascend by doc_id.

Blocks are decoded independently of each other, in any task.

Defined results: a null text is empty and has the end id alone; null ids
sort first; rows repeating a doc_id are all written, ordered by their ids'
bytes; an empty table gives an empty file.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecspark.llm.common import scratch_path, stored, string_list
from vecspark.llm.huffman import Code, code_lengths, limit_for
from vecspark.llm.tokens import token_parts

BLOCK = 1 << 16


def _tokenised(rows: DataFrame, path: str, end_id: int) -> DataFrame:
    """``doc_id, ids, counts``: ids of every row, and one row per task with its counts of ids."""

    def run(batches):
        totals = None
        for batch in batches:
            for first, found in token_parts(batch.column("text"), path):
                ids = [np.append(x, np.array([end_id], dtype=x.dtype)) for x in found]
                seen = np.bincount(np.concatenate(ids)) if ids else np.zeros(0, dtype=np.int64)
                if totals is None or len(seen) > len(totals):
                    seen, totals = (totals if totals is not None else np.zeros(0, dtype=np.int64)), seen.astype(np.int64)
                totals[:len(seen)] += seen
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(ids)),
                     pa.array([x.astype("<u4" if x.itemsize == 4 else "<u2").tobytes() for x in ids], pa.binary()),
                     pa.array([x.itemsize for x in ids], pa.int32()), pa.nulls(len(ids), pa.binary())],
                    names=["doc_id", "ids", "width", "counts"])
        if totals is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, batch.column("doc_id").type), pa.nulls(1, pa.binary()), pa.array([0], pa.int32()),
                 pa.array([totals.astype("<i8").tobytes()], pa.binary())], names=["doc_id", "ids", "width", "counts"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, width int, counts binary")


def _counts(tokenised: DataFrame) -> DataFrame:
    """``id, n`` over all documents."""

    def run(batches):
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                n = np.frombuffer(raw, dtype="<i8")
                kept = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"id": kept.astype(np.int64), "n": n[kept]})

    return tokenised.where("counts is not null").select("counts").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(
        F.sum("n").alias("n"))


def _blocks(rows: DataFrame, lengths: np.ndarray) -> DataFrame:
    """Blocks of each partition of sorted ``doc_id, ids, width`` rows."""
    shared = rows.sparkSession.sparkContext.broadcast(lengths)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        code, part, block, first = Code(shared.value), TaskContext.get().partitionId(), 0, 0
        held: list[tuple[object, np.ndarray]] = []
        size = 0

        def close():
            payload, offsets = code.encode(np.concatenate([x for _, x in held]))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([[k for k, _ in held]], pa.list_(ids_type)),
                 string_list(np.array([len(x) for _, x in held], dtype=np.int64), np.array([0, len(held)])),
                 string_list(offsets.astype(np.int64), np.array([0, len(offsets)])), pa.array([payload], pa.binary())],
                names=["part", "block", "first", "doc_ids", "doc_lengths", "offsets", "payload"])

        for batch in batches:
            ids_type = batch.column("doc_id").type
            for key, raw, width in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(),
                                       batch.column("width").to_pylist(), strict=True):
                ids = np.frombuffer(raw, dtype=f"<u{width}")
                if held and size + len(ids) > BLOCK:
                    yield close()
                    block, first, held, size = block + 1, first + size, [], 0
                held.append((key, ids))
                size += len(ids)
        if held:
            yield close()

    return rows.mapInArrow(run, f"part int, block int, first bigint, doc_ids array<{kind}>, doc_lengths array<bigint>, "
                                "offsets array<bigint>, payload binary")


def write(docs: DataFrame, to: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Write the token file of ``docs`` to the folder ``to``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    tokenised = stored(_tokenised(rows, tokenizer_path, end_id), "ids")
    counts = _counts(tokenised).toArrow()
    ids, n = counts.column("id").to_numpy(), counts.column("n").to_numpy()
    table = np.zeros(int(ids.max(initial=-1)) + 1, dtype=np.int64)
    table[ids] = n
    lengths = code_lengths(table, limit_for(len(ids)))
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, length int").coalesce(1).write.parquet(f"{to}/codes")
    ids_rows = tokenised.where("counts is null").select("doc_id", "ids", "width")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = ids_rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    _blocks(ordered, lengths).write.option("compression", "zstd").parquet(f"{to}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of a token file's documents."""
    codes = spark.read.parquet(f"{path}/codes").toArrow()
    lengths = np.zeros(max(codes.column("id").to_pylist(), default=-1) + 1, dtype=np.uint8)
    lengths[codes.column("id").to_numpy()] = codes.column("length").to_numpy()
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = blocks.select("part", F.aggregate("doc_lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    sizes = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    bases = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        code = Code(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 8):
                part = batch.slice(at, 8)
                sizes = [np.array(x, dtype=np.int64) for x in part.column("doc_lengths").to_pylist()]
                found = code.decode(part.column("payload").to_pylist(),
                                    [np.array(x, dtype=np.int64) for x in part.column("offsets").to_pylist()],
                                    [int(x.sum()) for x in sizes])
                starts, lens, raws = [], [], []
                for first, own, ids in zip(part.column("start").to_pylist(), sizes, found, strict=True):
                    ends = np.cumsum(own)
                    starts.extend((first + ends - own).tolist())
                    lens.extend(own.tolist())
                    raws.extend(ids[e - s:e].astype("<u4").tobytes() for s, e in zip(own, ends, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_ids").flatten(), pa.array(starts, pa.int64()), pa.array(lens, pa.int64()),
                     pa.array(raws, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    placed = blocks.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.col("first")).alias("start"), "doc_ids", "doc_lengths", "offsets", "payload")
    return placed.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")


def op5_token_file(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from vecspark.llm.common import table

    to = scratch_path(spark, "token_file")
    write(table(spark, sf_dir, "documents"), to, public_tokenizers.path("word_bpe_49k.json"))
    # crc32 of the little-endian 32-bit ids, as read from the blocks
    return read(spark, to).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

