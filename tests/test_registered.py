"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
import compare

SF = "/root/testdata/sf0.001"
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, con, name):
    ok, note = compare.compare(spark, con, SF, name, entry_module.queries()[name], SQL.get(name))
    assert ok, note


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_module.queries())
