import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.helpers import ODD, frame
from vecspark.llm import token_file as T
from vecspark.llm.common import scratch_path
from vecspark.llm.huffman import Code, code_lengths
from vecspark.llm.tokens import PieceTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_pieces_give_the_librarys_ids():
    own, library = PieceTokenizer(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(1)
    alphabet = ["a", "Z", "é", "ß", "'s", "'", "9", " ", "\n", "\xa0", "!", "<|endoftext|>", "日", "Σ", "İ", "́", "ª", "don't", "<|", "\x1c"]
    texts = [x for x in ODD if x is not None] + ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(500)]
    got = own.encode(texts)
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [x.tolist() for x in got] == want


@pytest.mark.parametrize("limit", [4, 6, 16])
def test_lengths_are_a_limited_prefix_code_and_optimal_for_few_symbols(limit):
    rng = np.random.default_rng(limit)
    for n in (1, 2, 3, 9, 16):
        counts = rng.integers(1, 1000, n) ** 2
        lengths = code_lengths(counts, limit).astype(int)
        assert lengths.max() <= limit and (n == 1 or abs((2.0 ** -lengths).sum() - 1) < 1e-12)
        if 1 < n <= 3:
            assert sorted(lengths) == {2: [1, 1], 3: [1, 2, 2]}[n]


def test_encode_decode_round_trip():
    rng = np.random.default_rng(3)
    for n_symbols, n in ((1, 10), (2, 1000), (500, 70_000), (40_000, 5000)):
        ids = [np.minimum(rng.geometric(0.01, m), n_symbols) - 1 for m in (n, 1, 255, 256, 257)]
        counts = np.bincount(np.concatenate(ids), minlength=n_symbols)
        code = Code(code_lengths(counts, 16))
        coded = [code.encode(x) for x in ids]
        back = code.decode([c[0] for c in coded], [c[1] for c in coded], [len(x) for x in ids])
        assert all((a == b).all() for a, b in zip(ids, back, strict=True))


def test_file_round_trip(spark):
    rows = [*ODD, *(" ".join(random.Random(i).choices(["word", "Other", "thing,"], k=i)) for i in range(40)), "long " * 80_000]
    ids = [3 * i % 101 for i in range(len(rows))]
    docs = frame(spark, rows, ids=ids)
    to = scratch_path(spark, "test")
    T.write(docs, to, PATH)
    got = {r["doc_id"]: r for r in T.read(spark, to).collect()}
    library, start = Tokenizer.from_file(PATH), 0
    for i in sorted(ids):
        text = rows[ids.index(i)] or ""
        want = np.array(library.encode(text, add_special_tokens=False).ids + [2], dtype="<u4")
        r = got[i]
        assert (r["start"], r["n_tokens"], zlib.crc32(r["ids"])) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_repeated_and_null_ids_and_empty_table(spark):
    docs = frame(spark, ["b", "a", "c", "a"], ids=[1, 1, None, 1])
    to = scratch_path(spark, "test")
    T.write(docs, to, PATH)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in T.read(spark, to).collect())
    assert [x[1] for x in got] == [None, 1, 1, 1] and [x[0] for x in got] == [0, 2, 4, 6]
    to = scratch_path(spark, "test")
    T.write(docs.limit(0), to, PATH)
    assert T.read(spark, to).count() == 0
