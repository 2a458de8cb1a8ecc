from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.operators import kpis, lines, marts, staging

D = dt.date


@pytest.fixture()
def orders(spark):
    data = [
        (1, 10, D(2024, 6, 1), "completed", 10.10),
        (2, 10, D(2024, 6, 2), "cancelled", 5.00),
        (3, 10, D(2024, 1, 1), "returned", 7.00),
        (4, 11, D(2024, 6, 3), "cancelled", 9.99),
        (5, 11, None, "completed", 20.02),
        (6, None, D(2024, 6, 4), "completed", 1.00),
        (7, 99, D(2023, 1, 1), "completed", 2.00),
    ]
    return spark.createDataFrame(data, schemas.ORDERS)


@pytest.fixture()
def customers(spark):
    data = [
        (i, "F", "L", "e@x", D(2020, 1, 1), region, "Consumer")
        for i, region in ((10, "North"), (11, "South"), (12, "South"))
    ]
    return spark.createDataFrame(data, schemas.CUSTOMERS)


@pytest.fixture()
def items(spark):
    data = [
        (100, 1, 1, 2, 1.25),
        (101, 1, 2, 1, 7.60),
        (102, 2, 1, 1, 5.00),
        (103, 5, 3, 2, 10.01),
        (104, 77, 1, 1, 1.00),
        (105, None, 1, 1, 1.00),
    ]
    return spark.createDataFrame(data, schemas.ORDER_ITEMS)


@pytest.fixture()
def products(spark):
    data = [(1, "mug ", "Home", 1.0, 1.25), (2, "mug", "Home", 3.0, 7.6), (3, "pen", "Office", 5.0, 10.01)]
    return staging.stg_products(spark.createDataFrame(data, schemas.PRODUCTS))


def test_staging_drops_missing_keys_and_keeps_repeats(spark):
    data = [
        (1, " Ann ", "Lee ", " A@X.Com ", None, "N", "S"),
        (1, "Bo", "Ek", "b@x", None, "N", "S"),
        (None, "C", "D", "c@x", None, "N", "S"),
    ]
    got = rows(staging.stg_customers(spark.createDataFrame(data, schemas.CUSTOMERS)).drop("signup_date"))
    assert got == [(1, "Ann", "Lee", "a@x.com", "N", "S"), (1, "Bo", "Ek", "b@x", "N", "S")]


def test_staging_trims_spaces_only(spark):
    reviews = spark.createDataFrame(
        [(1, 1, 1, 1, None, 2, " \tgood \n ", "none")], schemas.REVIEWS
    )
    staged = staging.stg_reviews(reviews)
    assert staged.first()["review_text"] == "\tgood \n"
    assert "true_issue_type" not in staged.columns


def test_line_amount_and_margin(spark, items, products):
    amounts = {r["order_item_id"]: r["line_amount"] for r in staging.stg_order_items(items).collect()}
    assert amounts[100] == 2.5 and amounts[103] == 20.02
    assert rows(products.select("product_id", "margin")) == [(1, 0.25), (2, 4.6), (3, 5.01)]


def test_fact_drops_lines_without_order(items, orders):
    fct = marts.fct_transactions(staging.stg_order_items(items), orders)
    assert [r[0] for r in rows(fct.select("order_item_id"))] == [100, 101, 102, 103]


@pytest.mark.parametrize("unique_orders", [False, True])
def test_mart(customers, orders, unique_orders):
    mart = marts.mart_customer_performance(
        marts.dim_customer(customers), orders, D(2024, 6, 30), unique_orders
    )
    got = {r["customer_id"]: r.asDict() for r in mart.collect()}
    assert set(got) == {10, 11, 12}
    assert got[10]["total_orders"] == 3 and got[10]["completed_orders"] == 1
    assert got[10]["total_revenue"] == 10.1 and got[10]["avg_order_value"] == 10.1
    assert got[10]["cancellation_rate"] == 0.3333
    assert got[10]["first_order_date"] == D(2024, 1, 1)
    assert got[11]["last_order_date"] == D(2024, 6, 3) and got[11]["is_active_customer"]
    assert got[12]["total_orders"] == 0 and got[12]["total_revenue"] == 0.0
    assert got[12]["avg_order_value"] == 0.0 and got[12]["cancellation_rate"] == 0.0
    assert got[12]["first_order_date"] is None and not got[12]["is_active_customer"]


def test_repeated_orders_count_once(spark):
    data = [
        (1, 10, D(2024, 1, 1), "completed", 1.0),
        (1, 10, D(2024, 1, 2), "completed", 2.0),
        (1, 10, D(2024, 1, 3), "returned", 4.0),
        (None, 10, D(2024, 1, 4), "completed", 8.0),
    ]
    orders = spark.createDataFrame(data, schemas.ORDERS)
    facts = marts.customer_order_facts(orders).first()
    assert (facts["total_orders"], facts["completed_orders"], facts["returned_orders"]) == (1, 1, 1)
    assert facts["total_revenue"] == 11.0
    by_status = marts.orders_by_status(orders).first()
    assert (by_status["completed_orders"], by_status["cancelled_orders"]) == (1, 0)
    assert marts.orders_per_customer(orders).first()["total_orders"] == 1


def test_dim_date(spark, orders):
    one_day = orders.where("order_id = 1")
    assert rows(marts.dim_date(one_day)) == [(D(2024, 6, 1), 2024, 6, 1, 6, "2024-06")]
    assert rows(marts.dim_date(orders.where("false"))) == []
    assert marts.dim_date(orders).count() == (D(2024, 6, 4) - D(2023, 1, 1)).days + 1


def test_products_of_one_name_are_taken_together(items, orders, products):
    fct = marts.fct_transactions(staging.stg_order_items(items), orders)
    assert rows(kpis.revenue_by_product(fct, products)) == [
        ("mug", "Home", 10.1),
        ("pen", "Office", 20.02),
    ]
    assert rows(kpis.revenue_by_product_id(fct, products).select("product_id", "revenue")) == [
        (1, 2.5), (2, 7.6), (3, 20.02),
    ]
    assert [tuple(r) for r in kpis.top_products(fct, products, 1).collect()] == [
        ("pen", "Office", 20.02)
    ]


def test_ties_in_a_top_list_go_by_name(spark, orders, products):
    items = spark.createDataFrame([(1, 1, 3, 1, 5.0), (2, 1, 1, 1, 5.0)], schemas.ORDER_ITEMS)
    fct = marts.fct_transactions(staging.stg_order_items(items), orders)
    assert [r["product_name"] for r in kpis.top_products(fct, products, 1).collect()] == ["mug"]


def test_figures_of_empty_tables_are_zero(items, orders, customers, products):
    none = orders.where("false")
    fct = marts.fct_transactions(staging.stg_order_items(items), none)
    mart = marts.mart_customer_performance(customers.where("false"), none, D(2024, 6, 30))
    summary = kpis.kpi_summary(fct, none, mart).first()
    assert tuple(summary)[:4] == (0.0, 0.0, 0.0, 0)
    assert kpis.order_cancellation_rate(none).first()[0] == 0.0
    assert kpis.revenue_last_month(fct, D(2024, 6, 30)).first()["revenue"] == 0.0


def test_summary(items, orders, customers):
    fct = marts.fct_transactions(staging.stg_order_items(items), orders)
    mart = marts.mart_customer_performance(customers, orders, D(2024, 6, 30))
    got = kpis.kpi_summary(fct, orders, mart).first().asDict()
    assert got["total_revenue"] == 30.12
    assert got["avg_order_value"] == 8.28
    assert got["cancellation_rate"] == round((0.3333 + 0.5 + 0) / 3, 4)
    assert got["active_customers"] == 2
    assert got["total_revenue_text"] == "$30" and got["cancellation_rate_text"] == "27.8%"
    assert kpis.order_cancellation_rate(orders).first()[0] == 0.2857


def test_revenue_by_region_and_month(items, orders, customers):
    fct = marts.fct_transactions(staging.stg_order_items(items), orders)
    assert rows(kpis.revenue_by_region(fct, customers, None)) == [("North", 10.1), ("South", 20.02)]
    assert [r[0] for r in kpis.revenue_by_region(fct, customers, 1).collect()] == ["South"]
    assert rows(kpis.revenue_by_month(fct)) == [("2024-06", 10.1)]
    assert tuple(kpis.revenue_last_month(fct, D(2024, 7, 15)).first()) == ("2024-06", 10.1)


def test_first_items_and_totals(items, orders, products):
    assert rows(lines.first_item_per_order(items)) == [(1, 1), (2, 1), (5, 3), (77, 1)]
    assert rows(lines.order_totals(items.where("order_id is not null"))) == [
        (1, 10.1), (2, 5.0), (5, 20.02), (77, 1.0),
    ]
    named = lines.order_first_product(orders, items, products)
    assert rows(named.select("order_id", "product_name")) == [(1, "mug"), (2, "mug"), (5, "pen")]


def test_sample_is_repeatable_and_without_replacement(orders):
    one = rows(lines.review_candidates(orders, 3).select("order_id"))
    again = rows(lines.review_candidates(orders.repartition(5), 3).select("order_id"))
    assert one == again and len(set(one)) == 3
    other = rows(lines.review_candidates(orders, 3, seed=7).select("order_id"))
    every = rows(lines.review_candidates(orders, 100).select("order_id"))
    assert len(other) == 3 and every == [(1,), (3,), (5,), (6,), (7,)]


def test_month_range_is_pushed_to_the_stored_fact(spark, tmp_path, items, orders):
    fct = marts.fct_transactions(staging.stg_order_items(items), orders)
    fct.write.parquet(str(tmp_path / "fct"))
    stored = spark.read.parquet(str(tmp_path / "fct"))
    plan = kpis.revenue_last_month(stored, D(2024, 7, 15))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(order_date,2024-06-01)" in plan
    assert "EqualTo(status,completed)" in plan
    schema = plan[plan.rindex("ReadSchema"):].split(">")[0]
    assert "line_amount" in schema and "unit_price" not in schema


def test_one_hot_customer(spark):
    orders = spark.range(30_000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("customer_id"),
        F.lit(D(2024, 1, 1)).alias("order_date"),
        F.lit("completed").alias("status"),
        F.lit(0.01).alias("order_total"),
    )
    facts = marts.customer_order_facts(orders).where("customer_id = 1").first()
    assert facts["total_orders"] == 10_001 and facts["total_revenue"] == 100.01
