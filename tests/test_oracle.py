"""Every named query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as contract
import check_oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_agrees(spark, con, sf_dir, name):
    ok, note = check_oracle.compare(spark, con, sf_dir, name)
    assert ok, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_sql_only_for_known_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
