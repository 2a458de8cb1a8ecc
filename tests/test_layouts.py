from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import rows

from tillroll.operators import marts
from tillroll.sources import layouts


@pytest.fixture()
def joins_by_sorting(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def orders(spark, n=2000):
    return spark.range(n).selectExpr(
        "id as order_id", "id % 91 as customer_id",
        "if(id % 100 = 7, null, date'2024-01-15' + cast(id % 150 as int)) as order_date",
        "element_at(array('completed', 'cancelled', 'returned'), cast(id % 3 as int) + 1) as status",
        "cast(id % 7 as double) as order_total",
    )


def test_months_are_pruned(spark, tmp_path):
    df, root = orders(spark), str(tmp_path)
    stored = layouts.write_by_month(df, root, "gold", "orders", "order_date", files_per_month=2)
    assert rows(stored.drop(layouts.MONTH)) == rows(df)
    folders = sorted(os.listdir(tmp_path / "gold" / "orders"))
    assert "order_month=2024-03" in folders and "order_month=__HIVE_DEFAULT_PARTITION__" in folders
    assert all(sum(f.endswith(".parquet") for f in os.listdir(tmp_path / "gold" / "orders" / d)) <= 2 for d in folders if "=" in d)
    march = layouts.read_by_month(spark, root, "gold", "orders", df.schema, "2024-03", "2024-03")
    plan = plan_of(march.groupBy("status").count())
    assert "PartitionFilters: [isnotnull(order_month" in plan and "PushedFilters: []" in plan
    own = df.where("order_date >= date'2024-03-01' and order_date < date'2024-04-01'")
    assert rows(march.drop(layouts.MONTH)) == rows(own)
    # Written again with fewer months, the others are gone.
    layouts.write_by_month(own, root, "gold", "orders", "order_date")
    assert layouts.read_by_month(spark, root, "gold", "orders", df.schema).count() == own.count()


@pytest.mark.parametrize("unique_orders", [False, True])
def test_bucketed_tables_meet_without_exchange(spark, tmp_path, joins_by_sorting, unique_orders):
    root, as_of = str(tmp_path), dt.date(2024, 6, 1)
    customers = spark.range(100).selectExpr(
        "id as customer_id", "'a' as first_name", "'b' as last_name", "'e' as email", "date'2024-01-01' as signup_date",
        "'North' as region", "'Consumer' as segment",
    )
    layouts.write_bucketed(orders(spark), root, "silver", "orders", "customer_id", 4)
    layouts.write_bucketed(customers, root, "silver", "customers", "customer_id", 4)
    fresh = spark.newSession()
    read = [
        layouts.read_bucketed(s, root, "silver", name, df.schema, "customer_id", 4)
        for s in (spark, fresh)
        for name, df in (("customers", customers), ("orders", orders(spark)))
    ]
    mart = marts.mart_customer_performance(read[0], read[1], as_of, unique_orders)
    assert "Exchange" not in plan_of(mart) and "SortMergeJoin" in plan_of(mart)
    assert rows(mart) == rows(marts.mart_customer_performance(customers, orders(spark), as_of, unique_orders))
    assert rows(read[2]) == rows(customers)


def test_items_meet_orders_without_exchange(spark, tmp_path, joins_by_sorting):
    root = str(tmp_path)
    items = spark.range(5000).selectExpr(
        "id as order_item_id", "if(id % 3 = 0, 0, id % 2500) as order_id", "id % 9 as product_id", "1 as quantity",
        "2.0D as unit_price", "2.0D as line_amount",
    )
    stored = [
        layouts.write_bucketed(df, root, "silver", name, "order_id", 8)
        for name, df in (("items", items), ("orders", orders(spark)))
    ]
    fct = marts.fct_transactions(*stored)
    assert "Exchange" not in plan_of(fct)
    assert rows(fct) == rows(marts.fct_transactions(items, orders(spark)))
