"""Every registered query with a SQL twin, compared on the smallest data set."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
RUN, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = RUN[name](spark, FOLDER)
    rows = df.collect()
    res = duck.execute(SQL[name])
    columns = [d[0] for d in res.description]
    assert differences(df.columns, rows, columns, res.fetchall()) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(RUN)


def test_entry(spark):
    assert entry.entry(spark).count() > 12
