"""Best-fit packing with certified bounds and exchange between partitions.

1. Documents become pieces of at most ``capacity`` tokens, in one pass that
   keeps only lengths and checksums.
2. Pieces are dealt to partitions of about ``PARTITION_PIECES`` by a hash.
   Each partition packs its pieces best-fit decreasing and computes a lower
   bound from dual feasible functions over its lengths; if both are equal,
   its bin count is certified optimal.
3. A certified partition closes all bins but its emptiest.  A partition with
   a gap opens its bins that leave over ``1 / ROOM`` of their space free.
   Pieces of open bins are exchanged between partitions by another hash and
   packed best-fit decreasing again, in ever fewer partitions, until all bins
   together are as few as the bound over all lengths (then the whole packing
   is certified), one partition takes the rest, or ``ROUNDS`` are over.

Only counts reach the driver, by length for the bound over all.  A partition holds a bounded number of
pieces; no key decides where a piece goes, so there is nothing to skew.

Defined results: a null text is empty and has the end id alone; an empty
table gives no rows; repeated rows are packed each on its own; texts are read
whole, whatever their length; extra columns are ignored; pieces of equal
length are placed by checksum, id and piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.common import stored
from vecspark.llm.tokens import token_parts

CAPACITY = 4096
PARTITION_PIECES = 50_000
ROOM = 64
ROUNDS = 8
# A sequence id holds the round (3 bits), the partition and the bin, 59 bits in all.
PARTITION_BITS, BIN_BITS = 24, 32


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every row's pieces."""

    def run(batches):
        for batch in batches:
            ids_col = batch.column("doc_id")
            for first, found in token_parts(batch.column("text"), path):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(found):
                    whole = np.append(ids, np.array([end_id], dtype=ids.dtype)).astype("<u4")
                    for k, at in enumerate(range(0, len(whole), capacity)):
                        part = whole[at:at + capacity]
                        row.append(first + i), piece.append(k), start.append(at), length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [ids_col.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each of the non-increasing ``lengths``, and the bins' free room.

    Bins wait in a stack per free room; a bit set of the rooms in use gives
    the smallest one that suffices.
    """
    bins, offsets, room = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64), []
    stacks: dict[int, list[int]] = {}
    rooms = 0
    for i, size in enumerate(lengths.tolist()):
        fits = rooms >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            stack = stacks[free]
            at = stack.pop()
            if not stack:
                rooms ^= 1 << free
        else:
            at, free = len(room), capacity
            room.append(capacity)
        bins[i], offsets[i] = at, capacity - free
        free -= size
        room[at] = free
        if free:
            stack = stacks.setdefault(free, [])
            if not stack:
                rooms |= 1 << free
            stack.append(at)
    return bins, offsets, room


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Best bound of two families of dual feasible functions.

    The first, for every cut-off up to half the capacity, counts lengths
    above ``capacity - cut`` as whole bins and drops those below the cut.  The
    second rounds ``(k + 1) * length / capacity`` down unless it is whole.
    """
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of_counts(count: np.ndarray, capacity: int) -> int:
    """The same of how many pieces there are of each length from 0 to ``capacity``."""
    n_to, sum_to = np.cumsum(count), np.cumsum(count * np.arange(capacity + 1))
    cut = np.arange(1, capacity // 2 + 1)
    large = n_to[capacity] - n_to[capacity - cut]
    middle = sum_to[capacity - cut] - sum_to[cut - 1]
    best = int((-(-(large * capacity + middle) // capacity)).max(initial=0))
    best = max(best, -(-int(sum_to[capacity]) // capacity))
    sizes = np.arange(capacity + 1)
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, sizes * k, (scaled // capacity) * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return best


def _packed(items: DataFrame, partitions: int, step: int, capacity: int) -> DataFrame:
    """``items`` with ``sequence_id, offset``, the partition's ``bins`` and ``bound``, and whether
    the bin is opened again."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by(
            [("length", "descending"), ("ids_crc32", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = rows.column("length").to_numpy()
        bins, offsets, room = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        room = np.array(room)
        opened = room * ROOM > capacity
        if len(room) == bound:
            opened &= np.arange(len(room)) == room.argmax()
        base = ((step << PARTITION_BITS) | TaskContext.get().partitionId()) << BIN_BITS
        rows = (rows.append_column("sequence_id", pa.array(base + bins)).append_column("offset", pa.array(offsets))
                .append_column("bins", pa.array(np.full(len(lengths), len(room), dtype=np.int64)))
                .append_column("bound", pa.array(np.full(len(lengths), bound, dtype=np.int64)))
                .append_column("opened", pa.array(opened[bins])))
        yield from rows.to_batches(max_chunksize=10_000)

    kind = items.schema["doc_id"].dataType.simpleString()
    dealt = items.select(*names).repartition(
        partitions, F.xxhash64(F.lit(step), "ids_crc32", F.col("doc_id").cast("string"), "piece"))
    return dealt.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                                 "sequence_id bigint, offset bigint, bins bigint, bound bigint, opened boolean")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``certified`` tells that all sequences together are as few as
    the bound over all lengths, or that those of the partition that closed this one were as few as its own."""
    lengths = items.groupBy("length").agg(F.count(F.lit(1)).alias("c")).collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in lengths:
        counts[r["length"]] = r["c"]
    least = bound_of_counts(counts, capacity)
    done, rest, step, count, closed_bins = None, items, 0, int(counts.sum()), 0
    while True:
        partitions = max(1, -(-count // PARTITION_PIECES))
        placed = stored(_packed(rest, partitions, step, capacity), f"packed{step}")
        first = F.col("offset") == 0  # one piece of each bin
        bins, kept, count = placed.agg(F.count_if(first), F.count_if(first & ~F.col("opened")), F.count_if("opened")).first()
        whole = closed_bins + bins == least
        last = whole or count == 0 or partitions == 1 and step > 0 or step + 1 == ROUNDS
        closed = placed if last else placed.where(~F.col("opened"))
        done = closed if done is None else done.unionAll(closed)
        if last:
            break
        rest, step, closed_bins = placed.where("opened").select(*items.columns), step + 1, closed_bins + kept
    return done.select(*items.columns, "sequence_id", "offset", (F.lit(whole) | (F.col("bins") == F.col("bound"))).alias("certified"))


def op10_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from vecspark.llm.common import table

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    return pack(stored(pieces(docs, path, capacity, end_id), "pieces"), capacity)
