"""Every registered query against its DuckDB oracle (the driver's check, at sf0.001)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare

SF = "/root/testdata/sf0.001"
SQL = E._own_oracle_sql()


def test_every_query_has_an_oracle():
    assert set(E._own_queries()) == set(SQL)


@pytest.mark.parametrize("name", sorted(E._own_queries()))
def test_query_matches_oracle(spark, name):
    assert compare(spark, name, E._own_queries()[name], SQL[name], SF) == []


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["query_idx", "vector_idx", "distance", "ranking"]
