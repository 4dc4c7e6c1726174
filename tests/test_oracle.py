"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as se
from wardflow.queries import all_queries
from wardflow.queries.oracle import compare, duckdb_views, type_differences

QUERIES = {n: q.fn for n, q in all_queries().items()}  # those of the training-data operators are tested in tests/llm
ORACLES = {n: q.oracle for n, q in all_queries().items() if q.oracle}


@pytest.fixture(scope="module")
def duck(sf_small):
    return duckdb_views(sf_small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    pdf = df.toPandas()
    if name.startswith("load_"):
        assert len(pdf), "a load that returns nothing proves nothing"
    why = compare(pdf, duck.execute(ORACLES[name]).df())
    assert why is None, why
    assert type_differences(df.schema, duck.sql(ORACLES[name])) == {}


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() >= 0
    assert "PatientPKHash" in df.columns
