import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import vecspark as vs
from vecspark.functions import codes as pc
from vecspark.functions import kernels


@pytest.mark.parametrize("m,ks", [(4, 16), (5, 7), (8, 200), (3, 300)])
@pytest.mark.parametrize("metric", ["l2", "ip", "l1", "linf"])
def test_table_search_equals_search_of_reconstructions(m, ks, metric):
    rng = np.random.default_rng(m * ks)
    books, centroid = rng.normal(size=(m, ks, 3)), 5 * rng.normal(size=3 * m)
    codes = rng.integers(0, ks, (700, m))
    codes[100:110] = codes[5]  # ties go to the lower id
    ids = rng.permutation(700)
    q = np.concatenate((rng.normal(size=(40, 3 * m)) + centroid, np.full((1, 3 * m), np.nan), 1e4 * rng.normal(size=(2, 3 * m))))
    words = pc.stored_words(pc.pack(codes, ks), m, ks)
    assert (pc.unpack(words, m, ks) == codes).all()
    whole = books[np.arange(m)[None], codes].reshape(700, -1) + centroid
    for how in ({"k": 7}, {"k": 1000}, {"radius": 4.0}):
        got, want = pc.search_codes(q, words, ids, centroid, books, metric, **how), kernels.search_block(q, whole, ids, metric, **how)
        assert all((a == b).all() for a, b in zip(got[:2], want[:2])) and np.array_equal(got[2], want[2])


@pytest.mark.parametrize("m,ks", [(4, 16), (5, 7), (3, 200), (3, 300)])
def test_packed_codes_as_arrays(spark, m, ks):
    codes = np.random.default_rng(1).integers(0, ks, (50, m))
    table = pa.table({"i": np.arange(50), "code": pc.pack(codes, ks)})
    assert len(table["code"][0].as_py()) == pc.code_width(m, ks)
    rows = spark.createDataFrame(table).select("i", vs.code_array("code", m, ks).alias("c")).orderBy("i").collect()
    assert [r["c"] for r in rows] == codes.tolist()


def test_sliced_columns_keep_their_rows():
    codes = np.arange(60).reshape(20, 3) % 16
    assert (pc.unpack(pc.stored_words(pc.pack(codes, 16).slice(4, 9), 3, 16), 3, 16) == codes[4:13]).all()
