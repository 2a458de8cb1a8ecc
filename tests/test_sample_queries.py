"""Every registered query against its SQL, on the smallest sample."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from oracle_sql import all_oracles
from tillroll.plans.sample_queries import sample_queries

SAMPLE = Path("/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not SAMPLE.exists(), reason="sample tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in SAMPLE.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def comparable(value):
    if isinstance(value, dt.datetime):
        return value.date()
    return value


def canonical(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(comparable(row[i]) for i in order) for row in found),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def test_every_query_has_its_sql():
    assert set(sample_queries()) == set(all_oracles())
    assert set(sample_queries()) <= set(entry.queries()) and set(all_oracles()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(sample_queries()))
def test_query_equals_sql(spark, con, name):
    ours = entry.queries()[name](spark, str(SAMPLE))
    theirs = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    their_types = dict(zip(columns, (str(d[1]) for d in theirs.description)))
    assert {c: TYPES[t] for c, t in ours.dtypes} == their_types
    assert canonical(ours.columns, ours.collect()) == canonical(columns, theirs.fetchall())
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert entry.entry(spark).count() == 10
