"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import ROOT, compare

SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, name):
    assert compare(spark, name, entry.queries()[name], SQL.get(name), f"{ROOT}/sf0.001") in (
        "",
        "empty on both sides",
    )


def test_every_twin_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
