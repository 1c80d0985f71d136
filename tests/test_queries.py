"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as driver
from strataload import catalog
from tools.compare import bag

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    assert sum(got.values()) > 0
    if name in ORACLES:
        cursor = duck.execute(ORACLES[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == bag(columns, cursor.fetchall())


def test_entry_has_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
