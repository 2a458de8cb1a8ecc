from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillroll.operators import checks
from tillroll.operators.checks import Check


@pytest.fixture()
def tables(spark):
    child = [(1, "a", 1), (2, "b", 1), (2, "z", 2), (None, None, None), (None, "z", 9), (3, "z", 9)]
    return {
        "child": spark.createDataFrame(child, "id long, code string, parent_id long"),
        "parent": spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, code string"),
        "days": spark.createDataFrame([(dt.date(2024, 1, 1),), (None,)], "day date"),
    }


def test_single_checks(tables):
    child, parent = tables["child"], tables["parent"]
    assert rows(checks.not_null(child, "id").select("parent_id")) == [(9,), (None,)]
    assert rows(checks.unique(child, "id")) == [(2, 2)]
    assert rows(checks.relationships(child, "parent_id", parent, "id").select("id")) == [(3,), (None,)]
    assert checks.relationships(child, "code", parent, "code").count() == 3


def test_suite_agrees_with_single_checks(tables):
    suite = [
        Check("unique", "child", "id"),
        Check("not_null", "child", "id"),
        Check("unique", "child", "code"),
        Check("not_null", "child", "code"),
        Check("relationships", "child", "parent_id", "parent", "id"),
        Check("relationships", "child", "code", "parent", "code"),
        Check("unique", "parent", "id"),
        Check("not_null", "days", "day"),
        Check("unique", "days", "day"),
    ]
    report = checks.run_checks(tables, suite).collect()
    got = {(r["test"], r["table"], r["column"]): r["failures"] for r in report}
    assert got == {
        ("unique", "child", "id"): 1,
        ("not_null", "child", "id"): 2,
        ("unique", "child", "code"): 1,
        ("not_null", "child", "code"): 1,
        ("relationships", "child", "parent_id"): 2,
        ("relationships", "child", "code"): 3,
        ("unique", "parent", "id"): 1,
        ("not_null", "days", "day"): 1,
        ("unique", "days", "day"): 0,
    }


def test_empty_table_passes(tables):
    empty = {name: df.where("false") for name, df in tables.items()}
    suite = [Check("unique", "child", "id"), Check("relationships", "child", "id", "parent", "id")]
    report = checks.run_checks(empty, suite)
    assert [r["failures"] for r in report.collect()] == [0, 0]
    checks.require_passed(report)


def test_failures_stop_the_caller(tables):
    report = checks.run_checks(tables, [Check("unique", "child", "id")])
    with pytest.raises(checks.ChecksFailed, match=r"unique\(child.id\): 1"):
        checks.require_passed(report)


def test_suite_holds_the_24_checks():
    kinds = [c.test for c in checks.SUITE]
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("relationships")) == (10, 12, 2)


def test_hot_value(spark):
    child = spark.range(30_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("fk")
    )
    tables = {"child": child, "parent": spark.range(30_000)}
    suite = [Check("unique", "child", "fk"), Check("relationships", "child", "fk", "parent", "id")]
    got = {r["test"]: r["failures"] for r in checks.run_checks(tables, suite).collect()}
    assert got == {"unique": 1, "relationships": 10_000}
