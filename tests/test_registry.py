"""The driver contract: every query of the catalog equals its DuckDB SQL at sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from vitrail.plans import catalog, oracles
from vitrail.plans.compare import compare, duck_connection

from .conftest import SF01

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF01)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(catalog.registry()) == set(oracles.registry())


@pytest.mark.parametrize("name", sorted(oracles.registry()))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    rel = duck.sql(ORACLES[name])
    diff = compare(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall())
    assert diff is None, diff


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["method", "precision", "recall", "f_measure"] and len(rows) == 1
