"""Every query against its SQL; ORACLE_SF picks the scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from cadenza.checks.oracle import ORACLE_SQL as SQL
from cadenza.checks.queries import QUERIES
from oracle_compare import compare

FOLDER = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, name):
    found, wanted = compare(spark, name, QUERIES[name], SQL[name], FOLDER)
    assert found[0] == wanted[0]
    assert wanted[1], "the check would compare two empty results"
    assert found[1] == wanted[1]


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
