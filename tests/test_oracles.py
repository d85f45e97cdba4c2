"""Every registered query against its DuckDB SQL; those without SQL must run and return rows."""

import pytest
from tests.conftest import SF

from tesserae.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, same_as_oracle):
    same_as_oracle(QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert {r["sample"] for r in e.entry(spark).collect()} >= {"TOTAL"}
    assert set(e.oracle_sql()) <= set(e.queries())
