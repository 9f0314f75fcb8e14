"""Every registered query against the comparison SQL."""

import pytest
from conftest import DATA

import __spark_entry__ as entry
import checks.oracle
import checks.queries

QUERIES, ORACLE = checks.queries.queries(), checks.oracle.oracle_sql()


def _rows(table):
    columns = sorted(table.column_names)
    rows = table.select(columns).to_pylist()
    rounded = [[round(v, 9) if isinstance(v, float) else v for v in row.values()] for row in rows]
    return columns, sorted(map(repr, rounded))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA).toArrow()
    want = duck.sql(ORACLE[name]).to_arrow_table()
    columns, rows = _rows(got)
    assert (columns, rows) == _rows(want)
    assert {c: str(got.schema.field(c).type) for c in columns} == {c: str(want.schema.field(c).type) for c in columns}


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
