"""Every registered query against its DuckDB counterpart."""

import pytest

import __spark_entry__ as entry
from conftest import duck_rows, spark_rows
from sluicework.plans.registry import ORACLES

FOLDER = "/root/testdata/sf0.001"


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 5


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    columns, rows = spark_rows(entry.queries()[name](spark, FOLDER))
    expected_columns, expected = duck_rows(FOLDER, entry.oracle_sql()[name])
    assert columns == expected_columns
    assert expected, "there must be something to compare"
    assert rows == expected


def test_pick_one_is_repeatable(spark):
    pick = entry.queries()["pick_one"]
    first, second = (pick(spark, FOLDER).collect() for _ in range(2))
    assert len(first) == 1 and first == second and first[0]["o_orderstatus"] == "O"
