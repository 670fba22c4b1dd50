"""Every registered query against its SQL, on the smallest tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from workload.oracle import SQL
from workload.queries import QUERIES

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (decimal.Decimal, int, float)):
        value = float(value)
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return "NULL" if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(SQL[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    actual = table(frame.columns, [tuple(r) for r in frame.collect()])
    assert actual[0] == expected[0]
    missing = list(set(expected[1]) - set(actual[1]))[:3]
    extra = list(set(actual[1]) - set(expected[1]))[:3]
    assert actual[1] == expected[1], f"missing {missing}\nextra {extra}"
    assert expected[1], "the result is empty"
