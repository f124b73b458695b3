"""Every registered query against its DuckDB SQL twin at sf0.01 (the driver's check)."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle_compare import compare, duckdb_connection

# the corpus operators' queries are tested with them, in tests/llm
NAMES = sorted(k for k in E.queries() if not re.fullmatch(r"op\d+_.*|pipeline", k))


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF01)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    assert compare(df, con, E.oracle_sql()[name]) == []
