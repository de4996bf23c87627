"""Every registered query against its DuckDB SQL on the smallest fixture."""

import pytest

import __spark_entry__ as E
from cuadra.plans import oracle, registry
from tests.conftest import SF_SMALL
from tools.compare import rows_of

KEYS = sorted(registry.QUERIES)


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(registry.QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = registry.QUERIES[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, got) == rows_of(cols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "gestion_gastoRiesgo_mes" in df.columns
