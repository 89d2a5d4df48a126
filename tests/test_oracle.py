"""Every registered query against its SQL, on whole tables. Set ORACLE_SF for other scales."""

import os
from pathlib import Path

import duckdb
import pytest

from verification import oracle, registry

SF_DIR = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.01')}"
QUERIES, SQL = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted([columns[i] for i in order]), sorted(
        (tuple(row[i] for i in order) for row in rows), key=repr
    )


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = _sorted(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(SQL[name])
    want = _sorted([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
