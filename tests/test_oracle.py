"""Every registered query against its DuckDB oracle (unordered compare) on sf0.001."""

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck_connect

# the training-data queries have their own tests
QUERIES = {k: f for k, f in entry.queries().items() if k in entry.registry.QUERIES}
ORACLES = {k: s for k, s in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return duck_connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    problems, ns, nd, _, _ = compare(spark, duck, name, QUERIES[name], ORACLES[name], sf_dir)
    assert not problems, problems


def test_every_query_has_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLES)
    assert not rows_only


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "id_iceberg" in df.columns
