"""Queries that SQL can express against it, over whole tables; all queries have stable columns."""

import math

import pytest

from sensorfold.llm import registry


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, duck, sf_dir, name):
    ours = registry.queries()[name](spark, sf_dir)
    theirs = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    assert _rows(ours.columns, map(tuple, ours.collect())) == _rows(names, theirs.fetchall())


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.queries() if n != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in registry.queries()
