import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.helpers import ODD, frame
from vecspark.llm import bin_packing as B

PATH = public_tokenizers.path("word_bpe_49k.json")


def optimum(lengths, capacity):
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + lengths[i] <= capacity:
                bins[j] += lengths[i]
                place(i + 1, bins)
                bins[j] -= lengths[i]
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


def test_bound_never_exceeds_the_optimum_nor_packing_falls_below():
    rng = random.Random(1)
    met = 0
    for _ in range(150):
        capacity = rng.choice([10, 24, 100])
        lengths = np.array(sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True))
        bins, offsets, room = B.best_fit_decreasing(lengths, capacity)
        best, bound = optimum(lengths.tolist(), capacity), B.lower_bound(lengths, capacity)
        assert bound <= best <= len(room)
        met += bound == len(room)
        for b in range(len(room)):
            at = 0
            for i in np.flatnonzero(bins == b):
                assert offsets[i] == at
                at += lengths[i]
            assert at + room[b] == capacity and room[b] >= 0
    assert met > 120


def check(rows, texts_by_id, capacity):
    library, sequences, seen = Tokenizer.from_file(PATH), {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        seen.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for i, text in texts_by_id.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want = [(k, a, len(ids[a:a + capacity]), zlib.crc32(ids[a:a + capacity].tobytes()))
                for k, a in enumerate(range(0, len(ids), capacity))]
        assert sorted(seen[i]) == want
    return len(sequences)


@pytest.mark.parametrize("per_partition", [50_000, 40])
def test_packing_is_whole_gapless_and_close_to_the_bound(spark, monkeypatch, per_partition):
    monkeypatch.setattr(B, "PARTITION_PIECES", per_partition)
    rng = random.Random(2)
    texts = [*ODD, *(" ".join(rng.choices(["red", "Blue", "green,"], k=rng.randint(1, 60))) for _ in range(300)), "long text " * 400]
    rows = B.pack_documents(frame(spark, texts), PATH, capacity=128).collect()
    n = check(rows, dict(enumerate(texts)), 128)
    bound = -(-sum(r["length"] for r in rows) // 128)
    assert bound <= n <= bound + (1 if per_partition > 1000 else 3)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = frame(spark, ["a b", "a b", None], ids=[1, 1, None])
    rows = B.pack_documents(docs, PATH).collect()
    assert sorted((r["doc_id"] or 0, r["length"]) for r in rows) == [(0, 1), (1, 3), (1, 3)]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 3
    assert B.pack_documents(docs.limit(0), PATH).count() == 0


def test_one_piece_a_sequence_is_certified_at_once_and_late_rounds_have_ids(spark):
    n = 4 * B.PARTITION_PIECES + 1000
    items = spark.range(n).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "2100 + id % 1500 AS length", "id * 7 AS ids_crc32")
    rows = B.pack(items).selectExpr("count(*)", "count(DISTINCT doc_id)", "count(DISTINCT sequence_id)", "max(offset)",
                                    "min(sequence_id)", "bool_and(certified)").first()
    assert tuple(rows)[:4] == (n, n, n, 0) and rows[4] >= 0 and rows[5]
    late = B._packed(items, 5, B.ROUNDS - 1, B.CAPACITY).selectExpr("count(DISTINCT sequence_id)", "min(sequence_id)", "max(sequence_id)").first()
    rounds = B.PARTITION_BITS + B.BIN_BITS
    assert late[0] == n and late[1] >> rounds == late[2] >> rounds == B.ROUNDS - 1


def test_partitions_with_gaps_exchange_until_the_bound_of_all_is_met(spark, monkeypatch):
    rng = random.Random(5)
    sizes = [rng.choice([40, 41, 30, 29, 30, 31]) for _ in range(600)]
    items = spark.createDataFrame([(i, 0, 0, n, i * 31) for i, n in enumerate(sizes)],
                                  "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint").repartition(3).cache()
    bound = B.lower_bound(np.array(sizes), 100)
    monkeypatch.setattr(B, "PARTITION_PIECES", 60)
    rows = B.pack(items, 100).collect()
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(r["doc_id"] for r in rows) == list(range(600))
    assert all(sum(n for _, n in x) <= 100 and sorted(x)[0][0] == 0 for x in used.values())
    one = len(B.best_fit_decreasing(np.sort(sizes)[::-1], 100)[2])
    assert bound <= len(used) <= one + 12
    assert len(used) > bound or all(r["certified"] for r in rows)
    items.unpersist()
