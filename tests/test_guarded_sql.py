from __future__ import annotations

import pytest
from conftest import rows

from tillroll.operators import guarded_sql


@pytest.mark.parametrize(
    ("sql", "reason"),
    [
        ("select 1", None),
        (" \n SELECT * from t", None),
        ("with w as (select 1) select * from w", "not a select"),
        ("select 'please drop it'", "forbidden keyword"),
        ("select 1; DELETE from t", "forbidden keyword"),
        ("select dropped, updated_at from t", None),
        ("select a from copy_of_t", None),
        ("update t set a = 1", "not a select"),
        ("", "not a select"),
        (None, "not a select"),
    ],
)
def test_verdicts(spark, sql, reason):
    df = spark.createDataFrame([(sql,)], "sql string")
    got = guarded_sql.guard_sql(df, "sql").first()
    assert (got["allowed"], got["reason"]) == (reason is None, reason)


@pytest.fixture()
def session(spark, tmp_path):
    path = str(tmp_path / "sales")
    spark.createDataFrame([(1, 2.5), (2, 4.0)], "id long, amount double").write.parquet(path)
    spark.range(1).createOrReplaceTempView("secret")
    return guarded_sql.readonly_session(spark, {"sales": path})


def test_run(session):
    got = guarded_sql.run_readonly_sql(session, "```sql\nSELECT sum(amount) AS total FROM sales\n```")
    assert rows(got) == [(6.5,)]


@pytest.mark.parametrize(
    "sql",
    [
        "drop table sales",
        "select 1; select 2",
        "select reflect('java.lang.System', 'getProperty', 'user.home')",
        "select Java_Method('java.lang.System', 'exit', 1)",
        "select * from secret",
        "select * from parquet.`/tmp`",
        "select * from nowhere",
        "select transform(id) using 'cat' as (b string) from sales",
        "select try_reflect('java.lang.System', 'getProperty', 'user.home')",
        "select `reflect`('java.lang.System', 'getProperty', 'user.home') from sales",
        "select * from range(10)",
        "select * from sales where id in (select id from secret)",
        "select * from gold.secret",
        "select * from `gold`.`secret`",
        "select * from `gold.sales`",
        "select * from default.kept",
    ],
)
def test_refused(session, sql):
    with pytest.raises(Exception):  # noqa: B017 - the guard or the analyser, before anything runs
        guarded_sql.run_readonly_sql(session, sql)


def test_catalog_tables_are_refused(spark, session):
    spark.sql("create table if not exists default.kept using parquet as select 1 as id")
    try:
        with pytest.raises(guarded_sql.QueryRefused):
            guarded_sql.run_readonly_sql(session, "select * from default.kept")
    finally:
        spark.sql("drop table default.kept")


@pytest.mark.parametrize(
    ("sql", "expected"),
    [
        ("select sum(amount) from gold.sales", [(6.5,)]),
        ("select s.id from GOLD . Sales s where s.amount > (select avg(amount) from gold.sales)", [(2,)]),
        ("select 'gold.sales', count(*) from sales", [("gold.sales", 2)]),
        ("select sum(s.amount) from `gold`.`sales` s join gold.`Sales` t using (id)", [(6.5,)]),
        ("select count(*) as `gold.sales` from `gold` . sales -- don't read gold.secret", [(2,)]),
        ("select /* it's */ count(*) from `gold`.sales tablesample (100 percent)", [(2,)]),
        ("select id, row_number() over (order by id) from sales order by 1 limit 1", [(1, 1)]),
        ("select t.x from (select explode(array(1, 2)) as x) t union all select 3", [(1,), (2,), (3,)]),
    ],
)
def test_listed_tables_by_either_name(session, sql, expected):
    assert rows(guarded_sql.run_readonly_sql(session, sql)) == expected


def test_guard_keeps_the_callers_columns(spark):
    df = spark.createDataFrame([("select 1", "x")], "sql string, lowered string")
    got = guarded_sql.guard_sql(df, "sql").first()
    assert got["lowered"] == "x" and got["allowed"]


def test_describe(spark):
    got = guarded_sql.describe_tables({"t": spark.createDataFrame([], "a long, b string")})
    assert rows(got) == [("t", "a, b")]
