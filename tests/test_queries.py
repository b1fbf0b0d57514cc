"""Each registered query of the catalogue against its DuckDB equivalent on the smallest tables; the others for rows and schema."""

from __future__ import annotations

import pytest
from saltmarsh.plans import catalogue

from .conftest import SMALL

QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_duckdb(name, same_as_duck):
    same_as_duck(QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_gives_rows(name, spark):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_oracles_belong_to_queries():
    assert ORACLES.keys() <= QUERIES.keys()


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert entry.entry(spark).columns[:2] == ["symbol", "date"]
