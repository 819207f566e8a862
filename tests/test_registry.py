"""Every registered query against its DuckDB oracle on the smallest test scale."""

import pytest

import __spark_entry__ as E
from check_oracles import compare, duck
from conftest import SF_SMOKE
from skyledger.plans.registry import oracle_sql, queries

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["shower", "meteors_counted"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMOKE)
    problems, n_spark, n_duck = compare(df, con, E.oracle_sql()[name])
    assert not problems, problems
