"""Every registered query against its SQL on the smallest tables."""

import check
import pytest

import __spark_entry__ as entry

PATH = f"{check.ROOT}/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, name):
    assert check.compare(spark, name, entry.queries()[name], ORACLE.get(name), PATH) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["acct", "event_id", "direction", "amount", "balance"]
