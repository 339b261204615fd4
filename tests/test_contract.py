"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in contract.queries().items() if name not in contract.CORPUS}
SQL = {name: text for name, text in contract.oracle_sql().items() if name not in contract.CORPUS}

needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def duck():
    compare = pytest.importorskip("oracle.compare")
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@needs_data
def test_entry_returns_one_row_per_month(spark):
    df = contract.entry(spark)
    assert df.count() == df.select("month").distinct().count() > 0


@needs_data
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    from oracle.compare import differences

    assert differences(QUERIES[name](spark, FOLDER), duck, SQL[name]) == []


@needs_data
@pytest.mark.parametrize("name", ["audit_publish", "run_history"])
def test_history_is_the_same_on_a_second_call(spark, name):
    first, second = (sorted(map(tuple, QUERIES[name](spark, FOLDER).collect()), key=str) for _ in range(2))
    assert first == second != []
