import numpy as np
import pytest

from vecspark.llm import cover_codes as cc


def brute(rows, entries=16, rounds=6, parts=8):
    """``{id: (code, errors)}`` by comparing every part with every entry."""
    x = np.array([np.floor(np.array(v, dtype=float) * 4096) for _, v in rows]).astype(np.int64)
    width = x.shape[1] // parts
    codes, errors = [], []
    for p in range(parts):
        v = x[:, p * width:(p + 1) * width]
        book = v[:entries].copy()
        for last in [False] * rounds + [True]:
            d = ((v[:, None] - book[None]) ** 2).sum(2)
            best = d.argmin(1)
            if not last:
                for e in range(len(book)):
                    if (best == e).any():
                        book[e] = v[best == e].sum(0) // (best == e).sum()
        codes.append(best), errors.append(d.min(1))
    return {i: (list(c), list(e)) for (i, _), c, e in zip(rows, np.array(codes).T, np.array(errors).T, strict=True)}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "p") for i, v in rows], "vec_id bigint, embedding array<float>, code string, points string")


@pytest.mark.parametrize("seed,spread", [(1, 0.02), (2, 1.0), (3, 0.0)])
def test_trees_give_what_comparing_everything_gives(spark, monkeypatch, seed, spread):
    monkeypatch.setattr(cc, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((9, 16))
    rows = [(i, [float(np.float32(x)) for x in centers[i % 9] + spread * rng.standard_normal(16)]) for i in range(500)]
    coded, _ = cc.compress(frame(spark, rows))
    assert {r["vec_id"]: (r["code"], r["errors"]) for r in coded.collect()} == brute(rows)


def test_whole_subtrees_are_assigned_on_clustered_points():
    rng = np.random.default_rng(4)
    centers = rng.integers(-10**6, 10**6, (8, 6))
    points = centers[rng.integers(0, 8, 4000)] + rng.integers(-50, 50, (4000, 6))
    tree = cc.CoverTree(points)
    sums, counts, found = tree.assign(points, centers, True)
    best = ((points[:, None] - centers[None]) ** 2).sum(2).argmin(1)
    assert (found == best).all() and (counts == np.bincount(best, minlength=8)).all()
    assert (sums == np.array([points[best == e].sum(0) for e in range(8)])).all()
    assert tree.compared < 100


def test_odd_rows(spark):
    good = [float(i) / 7 for i in range(8)]
    rows = [(3, None), (4, []), (5, [1.0] * 7 + [None]), (6, [float("nan")] * 8), (7, good), (7, good), (None, [0.5] * 8),
            (8, [1e30] * 8), (9, [1.0] * 16), (2, [float("inf")] * 8), (10, [0.25] * 8)]
    coded, books = cc.compress(frame(spark, rows))
    got = sorted(((r["vec_id"], tuple(r["code"]), sum(r["errors"])) for r in coded.collect()), key=repr)
    assert [g[0] for g in got] == [10, 7, 7, None] and got[1] == got[2] and all(g[2] == 0 for g in got)
    assert books.entries.shape == (8, 4, 1)
    empty, books = cc.compress(frame(spark, []))
    assert empty.count() == 0 and books.entries.size == 0


def test_sums_by_hot_and_rare_labels(spark):
    rows = [(i, None if i % 3 == 0 else f"l{i}" if i % 3 == 1 else "hot", i) for i in range(6000)]
    out = cc.total_by(spark.createDataFrame(rows, "i int, label string, e bigint"), "label", "e", "t").collect()
    want = {}
    for _, label, e in rows:
        want[label] = want.get(label, 0) + e
    assert len(out) == 6000 and all(r["t"] == want[r["label"]] for r in out)
