"""Every registered query against the SQL that must give the same rows."""

import datetime
import math
import os

import duckdb
import pytest

from graphloom.catalog import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
FOLDER = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((type(v).__name__, str(v)) for v in r))


def test_registry_is_complete():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = ordered([tuple(comparable(r[c]) for c in columns) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    index = [names.index(c) for c in columns]
    expected = ordered([tuple(comparable(r[i]) for i in index) for r in result.fetchall()])
    assert got == expected
    assert got
