"""Every registered query with an SQL check, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()

@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n in CHECKS if not n.startswith("op")))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, SF, QUERIES[name], CHECKS[name]) == []


def test_unchecked_queries_return_rows(spark):
    # Those of the llm folder have brute-force tests of their own.
    for name in set(QUERIES) - set(CHECKS):
        if name == "pipeline" or name.startswith("op"):
            continue
        assert QUERIES[name](spark, SF).limit(1).count() == 1, name


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["account", "archetype", "place", "aweme_id"] and df.count() > 0
