import random

import numpy as np
import pytest

from llm.helpers import ODD, frame, prose
from vecspark.llm import jaccard_join as jj


def shingles(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(texts, percent=80):
    sets, least = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                least[b] = a
    return {i: (len(sets[i]), root(i)) for i in range(len(texts))}


def changed(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_the_bounds_leave_no_pair_out():
    """Sets at the similarity share a key of a common band, and their sketches stay within the bound."""
    rng = np.random.default_rng(3)
    for n in [*range(1, 60), 100, 101, 320, 999, 4000]:
        for _ in range(3):
            common = rng.integers(0, 2**63, n, dtype=np.uint64)
            extra = rng.integers(0, 2**63, n, dtype=np.uint64)
            k = int(rng.integers(0, n // 4 + 1))
            for a, b in ((common, np.concatenate((common, extra[:k]))), (np.concatenate((common, extra[:k // 2])), np.concatenate((common, extra[n - k // 2:])))):
                a, b = np.unique(a), np.unique(b)
                both = len(np.intersect1d(a, b))
                if both == min(len(a), len(b)) == max(len(a), len(b)) or 100 * both < 80 * (len(a) + len(b) - both):
                    continue
                assert jj.hamming(jj.parity_sketch(a, 80), jj.parity_sketch(b, 80)) <= len(a) + len(b) - 2 * both
                shared = [set(jj.segment_keys(a, j, 80).tolist()) & set(jj.segment_keys(b, j, 80).tolist())
                          for j in set(jj.bands_of(len(a), 80)) & set(jj.bands_of(len(b), 80))]
                assert any(shared), (len(a), len(b), both)


@pytest.mark.parametrize("bucket,block,held", [(64, 512, 128), (2, 4, 1)])
def test_components_equal_comparing_everything(spark, monkeypatch, bucket, block, held):
    """Also where every bucket counts as large, so that families and blocks do the work."""
    monkeypatch.setattr(jj, "BUCKET", bucket), monkeypatch.setattr(jj, "BLOCK", block), monkeypatch.setattr(jj, "HELD", held)
    monkeypatch.setattr(jj, "SLICE", 10)
    rng = random.Random(bucket)
    base = [prose(s, rng.choice((5, 9, 30, 120)), 400) for s in range(12)]
    passage = prose(99, 60)
    texts = base + [changed(rng.choice(base), rng, rng.randrange(3)) for _ in range(40)] + [changed(base[3], rng, 2) for _ in range(25)]
    texts += [f"{prose(s, 40)} {passage} {prose(s + 500, 40)}" for s in range(200, 212)] + ODD + ["a b c d", "a b c d e", "A B C D"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jj.jaccard_components(frame(spark, texts)).collect()}
    assert got == brute(texts)


def test_repeated_and_null_ids_and_an_empty_table(spark):
    a, b = prose(1), prose(2)
    rows = jj.jaccard_components(frame(spark, [a, b, a, b + " w", a], ids=[5, 5, 7, 9, None])).collect()
    got = sorted((repr(r["doc_id"]), r["component_id"]) for r in rows)
    assert got == [("5", 5), ("5", 5), ("7", 5), ("9", 5), ("None", 5)]
    assert jj.jaccard_components(frame(spark, [])).count() == 0


def test_prefixes_that_occur_twice_are_found_in_packed_ranges(spark, monkeypatch):
    """Within a row, within a task and across tasks; no row is dealt for each key."""
    monkeypatch.setattr(jj, "KEYS_HELD", 300)
    rng = np.random.default_rng(8)
    once = rng.integers(-2**63, 2**63 - 1, 2000, dtype=np.int64).tolist()
    twice = rng.integers(-2**63, 2**63 - 1, 50, dtype=np.int64).tolist() + [-1, 0]
    rows = [once[i::40] + twice[i % 26::26] for i in range(40)] + [twice, twice[:3] * 4, []]
    shared = jj.shared_prefixes(spark.createDataFrame([(r,) for r in rows], "keys array<bigint>").repartition(3))
    cut = 64 - jj.PREFIX_BITS
    assert sorted(r["key"] for r in shared.collect()) == sorted({k >> cut << cut for k in twice})
    assert "explode" not in shared._jdf.queryExecution().toString()


def test_classes_that_share_too_few_keys_are_not_compared(spark):
    """A common passage gives some equal keys; a link needs as many as the bound leaves of either class."""
    band = next(i for i, b in enumerate(jj.size_bands(80)) if b[2] >= 20)
    differ = jj.size_bands(80)[band][2]
    keys = {1: range(0, 30), 2: range(0, 4), 3: range(26, 30), 4: range(4, 16)}
    rows = [(256 * k + band, i, i, 2) for i, own in keys.items() for k in own] + [(256 * 99 + band, 4, 4, jj.BUCKET + 1)]
    members = spark.createDataFrame(rows, "key long, id long, comp long, m long")
    filled = {1: differ + 5, 2: differ + 4, 3: differ + 3, 4: differ + 13}
    sketches = spark.createDataFrame([(i, [256 * k + band]) for i, k in filled.items()], "id long, filled array<long>")
    least = jj._least_shared(sketches, members, 80)
    assert {r["id"]: r["least"] for r in least.collect()} == {1: 5, 2: 4, 3: 3, 4: 12}
    pairs = jj._small_pairs(members.where(f"m <= {jj.BUCKET}"), least)
    assert [tuple(r) for r in pairs.collect()] == [(1, 4)]


def test_a_sketch_is_as_long_as_its_bound_asks():
    rng = np.random.default_rng(4)
    for n in (3, 60, 250, 4000):
        a, b = (np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(2))
        differ = next(x[2] for x in jj.size_bands(80) if n <= x[1])
        assert 8 * len(jj.parity_sketch(a, 80)) <= max(256, 12 * differ)
        assert n < 30 or jj.hamming(jj.parity_sketch(a, 80), jj.parity_sketch(b, 80)) > 2 * n // 9
