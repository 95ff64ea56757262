"""Every registered query against its DuckDB oracle (the driver's check), on sf0.001."""

import pytest

import __spark_entry__ as E
from ledgerflow.plans import registry
from tests.oracle_compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    if name in E.oracle_sql():
        ok, n_spark, n_duck = res
        assert ok, f"{name}: spark={n_spark} duck={n_duck}"
    else:
        assert res[1] >= 0


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(E.queries()) and set(registry.ORACLES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "daily_key" in df.columns
    assert df.count() > 0
