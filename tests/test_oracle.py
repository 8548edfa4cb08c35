"""Every query with an SQL twin returns the same rows, to the last bit."""

import pytest

import __spark_entry__ as entry
from ladle.catalog import QUERIES
from oracle.statements import all_statements

SQL = all_statements()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
ONLY_ROWS = {"train_eta", "score_batch", "training_runs_log"}


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert set(QUERIES) - set(SQL) == ONLY_ROWS
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(name, spark, folder, duck):
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    found = duck.execute(SQL[name])
    kinds = {d[0]: str(d[1]) for d in found.description}
    assert sorted(kinds) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    order = [list(kinds).index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in found.fetchall()]
    assert in_order(tuple(r) for r in df.select(*columns).collect()) == in_order(expected)


@pytest.mark.parametrize("name", sorted(ONLY_ROWS))
def test_has_rows(name, spark, folder):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
