import pytest

import __spark_entry__ as E
from oracle_compare import compare
from test_oracle import SF
from vecspark.llm.queries import ORACLES, QUERIES


def test_every_operator_and_the_pipeline_are_registered():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    assert compare(spark, name, QUERIES[name], ORACLES[name], SF) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
