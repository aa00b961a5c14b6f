import random
from collections import Counter

import pytest

from llm.helpers import ODD, frame
from vecspark.llm import suffix_dedup as S
from vecspark.llm.suffix_dedup import LevelFamily

import numpy as np


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    counts = Counter(x[i:i + length] for x in data for i in range(len(x) - length + 1))
    out = []
    for x in data:
        mark = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if counts[x[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(mark)) if mark[i] and not (i and mark[i - 1]))
        out.append((len(x), sum(mark), spans, bytes(b for b, m in zip(x, mark) if not m)))
    return out


def texts(seed, length):
    rng = random.Random(seed)
    passages = ["".join(rng.choices("abcdé ", k=rng.randint(length // 2, 4 * length))) for _ in range(6)]
    out = list(ODD)[:-3] + ["a" * (length + 1), "a" * (3 * length), "ab" * length, "x" * (length - 1), passages[0], passages[0]]
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts.append(p[a:a + rng.randint(1, len(p))])
            parts.append("".join(rng.choices("uvwxyz", k=rng.randint(0, length // 3))))
        out.append("".join(parts))
    return out


@pytest.mark.parametrize("length,most", [(40, 4000), (40, 1), (400, 4000)])
def test_removal_equals_brute_force(spark, monkeypatch, length, most):
    monkeypatch.setattr(S, "MOST_CLASSES", most)
    rows = texts(length, length)
    got = {r["doc_id"]: tuple(r)[1:] for r in S.remove_repeats(frame(spark, rows), length).collect()}
    want = brute(rows, length)
    assert {i: (a, b, c, bytes(d)) for i, (a, b, c, d) in got.items()} == dict(enumerate(want))


def test_level_family_marks_repeated_keys_in_any_batches():
    rng = np.random.default_rng(1)
    family, keys = LevelFamily(), []
    for _ in range(60):
        batch = rng.integers(0, 3000, rng.integers(0, 40)).astype(np.uint64)
        family.add(batch)
        keys.append(batch)
    keys = np.concatenate(keys)
    _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    assert (family.marked[:len(keys)] == (counts[place] > 1)).all()
    sizes = [len(k) for k, _ in family.levels]
    assert len(sizes) <= 12 and all(2 * b <= a for a, b in zip(sizes, sizes[1:]))


def test_runs_of_a_long_text_in_segments(monkeypatch, spark):
    monkeypatch.setattr(S, "_SEGMENT", 1000)
    rng = random.Random(5)
    long = "".join(rng.choices("abc", k=7000))
    rows = [long, long[1500:5500], "z" + long[300:900]]
    monkeypatch.setattr(S, "PART_BYTES", 500)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in S.remove_repeats(frame(spark, rows), 200).collect()}
    assert got == {i: w[1:3] for i, w in enumerate(brute(rows, 200))}


def test_repeated_rows_and_empty_table(spark):
    rows = ["q" + "".join(random.Random(9).choices("abc", k=900))] * 2
    docs = frame(spark, rows, ids=[4, 4])
    got = S.remove_repeats(docs).collect()
    assert [(r["doc_id"], r["n_removed"], bytes(r["kept"])) for r in got] == [(4, 901, b"")] * 2
    assert S.remove_repeats(docs.limit(0)).count() == 0


def brute_of_last(batches, length):
    """``brute`` of the last batch, among all of them."""
    return brute([t for b in batches for t in b], length)[-len(batches[-1]):] if batches[-1] else []


@pytest.mark.parametrize("most", [4000, 1])
def test_batches_are_judged_against_all_levels(spark, monkeypatch, tmp_path, most):
    monkeypatch.setattr(S, "MOST_CLASSES", most)
    rows = texts(3, 40)
    random.Random(8).shuffle(rows)
    batches = [rows[:30], rows[30:40], [], rows[40:44], rows[44:48], rows[48:], rows[:3], [None, "short"]]
    path = str(tmp_path / "index")
    S.create_index(spark, path, 40)
    for j, batch in enumerate(batches):
        # ids repeat from batch to batch, with other texts
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
               for r in S.add_batch(spark, path, frame(spark, batch)).collect()}
        assert got == dict(enumerate(brute_of_last(batches[:j + 1], 40))), j
        sizes = [level["rows"] for level in S.index_state(spark, path)["levels"]]
        assert all(2 * b <= a for a, b in zip(sizes, sizes[1:]))
    assert S.index_state(spark, path)["version"] == len(batches) and len(sizes) < 5


def test_a_failed_batch_leaves_the_version_before_it(spark, monkeypatch, tmp_path):
    path, text = str(tmp_path / "index"), "".join(random.Random(1).choices("abc", k=200))
    S.create_index(spark, path, 40)
    S.add_batch(spark, path, frame(spark, [text]))
    before = S.index_state(spark, path)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, "_write_level", fail)
        with pytest.raises(RuntimeError):
            S.add_batch(spark, path, frame(spark, ["new " + text]))
    assert S.index_state(spark, path) == before
    got = S.add_batch(spark, path, frame(spark, [text[20:120]])).first()
    assert (got["n_removed"], got["n_spans"]) == (100, 1)
