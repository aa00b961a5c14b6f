"""Searches from SQL text: the table function in many tiles, filters in the scan, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import vecspark as vs
from vecspark.functions import table


@pytest.fixture(scope="module")
def views(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.integers(0, 6, 5).astype(float).tolist(), int(i % 4)) for i in range(700)]  # with ties
    emb = spark.createDataFrame(rows, "id long, vector array<float>, label int")
    emb.createOrReplaceTempView("sql_items")
    emb.where("id % 3 = 0").createOrReplaceTempView("sql_asked")
    spark.createDataFrame([], emb.schema).createOrReplaceTempView("sql_none")
    vs.register_sql(spark)
    return emb


def _rows(df):
    return sorted((r["query_idx"], r["ranking"] if "ranking" in df.columns else 0, r["vector_idx"], round(r["distance"], 6))
                  for r in df.collect())


@pytest.mark.parametrize("metric", ["l2", "ip", "l1", "linf"])
def test_many_tiles_give_the_search_of_the_library(spark, views, metric, monkeypatch):
    monkeypatch.setattr(table, "TILE_ROWS", 90)
    monkeypatch.setattr(table, "BLOCK_ROWS", 50)
    index = vs.build_index(views, 5, "flat", metric, tag_columns=["label"])
    asked = spark.table("sql_asked")
    assert _rows(spark.sql(vs.knn_sql("sql_items", "sql_asked", 7, metric=metric))) == _rows(vs.knn(index, asked, 7))
    assert (_rows(spark.sql(vs.range_sql("sql_items", "sql_asked", 6.0, metric=metric, where="label <> 1")))
            == _rows(vs.range_search(vs.build_index(views.where("label <> 1"), 5, "flat", metric), asked, 6.0)))


def test_fewer_items_than_k_and_empty_tables(spark, views):
    assert spark.sql(vs.knn_sql("sql_items", "sql_asked", 5, where="id < 3")).count() == 3 * spark.table("sql_asked").count()
    assert spark.sql(vs.knn_sql("sql_none", "sql_asked", 5)).count() == 0
    assert spark.sql(vs.knn_sql("sql_items", "sql_none", 5)).count() == 0


def test_a_filter_reaches_the_files_of_a_stored_index(spark, views, tmp_path):
    index = vs.build_index(views, 5, "ivf_flat", nlist=4, shard=F.col("id") % 3, tag_columns=["label"])
    vs.save_index(index, str(tmp_path / "i"))
    vs.register_index(vs.load_index(spark, str(tmp_path / "i")), "sql_stored")
    assert spark.table("sql_stored_lists").count() == 12
    found = spark.sql(vs.knn_sql("sql_stored", "sql_asked", 5, where="shard_id = 1 AND label = 2"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(label,2)" in plan and "(shard_id#" in plan.split("PartitionFilters")[1]
    want = vs.knn(vs.build_index(views.where("id % 3 = 1 and label = 2"), 5), spark.table("sql_asked"), 5)
    assert _rows(found) == _rows(want)


def test_null_and_nonfinite_vectors(spark, views):
    odd = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [1.0, 1.0]), (3, [2.0, 1.0])], "id long, vector array<float>")
    odd.createOrReplaceTempView("sql_odd")
    assert _rows(spark.sql(vs.knn_sql("sql_odd", "sql_odd", 2))) == [(2, 1, 2, 0.0), (2, 2, 3, 1.0), (3, 1, 3, 0.0), (3, 2, 2, 1.0)]
    odd.select("id", F.when(F.col("id") > 1, F.col("vector")).alias("vector")).createOrReplaceTempView("sql_null")
    with pytest.raises(Exception, match="NULL vectors"):
        spark.sql(vs.knn_sql("sql_null", "sql_odd", 2)).collect()


def test_distances_as_sql_functions(spark, views):
    got = spark.sql("SELECT vec_l2(a, b), vec_ip(a, b), vec_l1(a, b), vec_linf(a, b) FROM "
                    "(SELECT array(1D, 2D) AS a, array(2D, 4D) AS b)").first()
    assert tuple(got) == (5.0, 10.0, 3.0, 2.0)


def test_wrong_names_raise(spark, views):
    with pytest.raises(ValueError):
        vs.knn_sql("sql_items", "sql_asked", 0)
    with pytest.raises(ValueError):
        vs.knn_sql("sql_items", "sql_asked", 3, metric="cosine?")
