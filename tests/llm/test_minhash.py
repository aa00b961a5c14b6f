import random
import re

import numpy as np
import pytest

from llm.helpers import ODD, frame, prose
from vecspark.llm import minhash as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(ids, texts, k, percent):
    sets, parent = [shingles(t, k) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, own in enumerate(ids):
        least[root(i)] = min(least.get(root(i), own), own)
    return {own: (len(sets[i]), least[root(i)], own == least[root(i)]) for i, own in enumerate(ids)}


def edited(text, n, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def corpus():
    texts = list(ODD)
    for base in range(6):
        text = prose(base, 120)
        texts += [text, text.upper(), text.replace(" ", "\n")]
        texts += [edited(text, i % 9, 100 * base + i) for i in range(40)]
    # a chain: each is near the next only
    w = [f"c{i}" for i in range(400)]
    texts += [" ".join(w[12 * i:12 * i + 200]) for i in range(12)]
    texts += [prose(50 + i, 30) for i in range(30)]
    return texts


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, k, percent):
    texts = corpus()
    ids = random.Random(k).sample(range(1000), len(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in M.near_duplicates(frame(spark, texts, ids=ids), k, percent).collect()}
    assert got == brute(ids, texts, k, percent)


def test_blocks_of_the_index_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(M, "INDEX_ROWS", 3)
    monkeypatch.setattr(M, "HUBS", 1)
    texts = corpus()
    ids = list(range(len(texts)))
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(frame(spark, texts, ids=ids), 3, 85).collect()}
    assert got == {k: v[1] for k, v in brute(ids, texts, 3, 85).items()}


def test_keep_one_keeps_clean_rows_and_columns(spark):
    texts = [prose(1), prose(1), edited(prose(1), 1, 3), prose(2), None, None, ""]
    docs = frame(spark, texts, ids=[5, 3, 4, 9, 1, 2, 8])
    kept = M.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 8, 9]


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(0)
    for share in (0.95, 0.85, 0.5):
        gaps = []
        for _ in range(30):
            common = rng.integers(0, 2**63, 2000, dtype=np.uint64)
            n = int(2000 * (1 - share) / (2 * share))
            a, b = (np.concatenate((common, rng.integers(0, 2**63, n, dtype=np.uint64))) for _ in range(2))
            x = M.odd_sketch(M.minhash(a)) ^ M.odd_sketch(M.minhash(b))
            flipped = int(np.unpackbits(x.view(np.uint8)).sum())
            gaps.append(M.SKETCH_BITS * (1 - (1 - 2 / M.SKETCH_BITS) ** (2 * M._HASHES * (1 - share))) / 2 - flipped)
        assert abs(np.mean(gaps)) < 8


@pytest.mark.parametrize("percent", [80, 85])
def test_sketch_limit_spares_pairs_at_the_threshold(percent):
    rng, worst, n = np.random.default_rng(percent), 0, 40
    both = rng.integers(0, 2**63, (300, percent * n), dtype=np.uint64)
    rest = rng.integers(0, 2**63, (300, (100 - percent) * n), dtype=np.uint64)
    for common, own in zip(both, rest, strict=True):
        half = len(own) // 2
        a, b = np.concatenate((common, own[:half])), np.concatenate((common, own[half:]))
        x = M.odd_sketch(M.minhash(a)) ^ M.odd_sketch(M.minhash(b))
        worst = max(worst, int(np.unpackbits(x.view(np.uint8)).sum()))
    # of 300 pairs at the threshold the farthest stays well inside: under four of the six standard deviations
    assert worst <= M.most_differing(percent, 4) < M.most_differing(percent, 6)


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 102), (102, 101)], "a bigint, b bigint")
    got = {r["node"]: r["comp"] for r in M.components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in (100, 101, 102)}


def test_null_and_repeated_ids_and_empty_table(spark):
    t = prose(3)
    rows = M.near_duplicates(frame(spark, [t, t, t, None, t + " x"], ids=[None, 7, 7, None, 9]), 3, 85).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"], r["kept"]) for r in rows if r["n_shingles"]) == [
        (False, 7, 7, True), (False, 7, 7, True), (False, 9, 7, False), (True, 0, 7, False)]
    rows = M.near_duplicates(frame(spark, [t + " x", t], ids=[None, 4]), 3, 85).collect()
    assert sorted((r["component_id"], r["kept"]) for r in rows) == [(4, False), (4, True)]
    assert M.near_duplicates(frame(spark, ["x"]).limit(0)).count() == 0


def test_keep_one_judges_rows_not_ids(spark):
    a, b = prose(1), prose(2)
    rows = [(1, a), (2, a), (2, b), (3, b), (3, b), (4, None), (4, ""), (5, prose(3))]
    docs = frame(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    kept = sorted(((r["doc_id"], r["text"]) for r in M.keep_one(docs).collect()), key=repr)
    assert kept == sorted([(1, a), (2, b), (4, None), (4, ""), (5, prose(3))], key=repr)


def test_strings_that_collide_modulo_a_power_of_two_stay_apart(spark):
    s = "a"
    while len(s) < 1024:
        s += s.translate(str.maketrans("ab", "ba"))
    texts = [s, s.translate(str.maketrans("ab", "ba"))]
    assert [r["component_id"] for r in M.near_duplicates(frame(spark, texts), 3, 85).orderBy("doc_id").collect()] == [0, 1]
