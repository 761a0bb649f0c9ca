"""Every registered query against its SQL, run by DuckDB over the same files."""

import math

import duckdb
import pytest

from orrery.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for name in tables:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, "nan" if isinstance(value, float) and math.isnan(value) else repr(float(value)))
    return (3, str(value))


def _rows(rows, order):
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def _kind(name):
    name = name.lower()
    if name in ("bigint", "long"):
        return "bigint"
    if name in ("int", "integer"):
        return "int"
    return {"varchar": "string", "timestamp_ntz": "timestamp"}.get(name, name)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    expected = duck.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(names)
    types = {c[0]: _kind(str(c[1])) for c in expected.description}
    ours = {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields}
    assert ours == types
    want = expected.fetchall()
    got = [tuple(row) for row in df.collect()]
    assert len(got) == len(want)
    assert want, "an oracle without rows proves nothing"
    by_name = sorted(names)
    assert _rows(got, [df.columns.index(c) for c in by_name]) == _rows(want, [names.index(c) for c in by_name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0
