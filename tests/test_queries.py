"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from check import compare, connect
from conftest import TINY

import __spark_entry__ as contract
from quarryline.plans import registry

@pytest.fixture(scope="module")
def db():
    return connect(TINY)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, db, name):
    verdict, _, rows = compare(spark, db, TINY, name)
    assert verdict == "ok"
    assert rows > 0 or name in MAY_BE_EMPTY


MAY_BE_EMPTY = {"map_unmapped_codes"}


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["month", "status"] and df.count() > 0
    months = [(r["month"], ["fulfilled", "open", "pending"].index(r["status"])) for r in df.collect()]
    assert months == sorted(months)
