"""Every registered query against its SQL, order-insensitive, over whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("events", "documents")


def _key(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_key(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return db


# The library's own queries; an optional subpackage tests its own.
CORE = sorted(n for n, q in contract.queries().items() if q.__module__ == contract.__name__)


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", CORE)
def test_matches_oracle(spark, duck, name):
    ours = contract.queries()[name](spark, SF)
    theirs = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    got = _rows(ours.columns, [tuple(r) for r in ours.collect()])
    want = _rows(names, theirs.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry(spark):
    assert contract.entry(spark).columns == ["measure", "max", "min", "avg", "cnt", "ts"]
    assert contract.entry(spark).count() > 0
