"""Gold layer: dimensions, the line-level fact, the calendar and the customer mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import day_of_week, is_active, year_month
from tillroll.functions.numbers import exact_sum, safe_ratio

# The order states.
ORDER_STATUSES = ("completed", "cancelled", "returned")


def dim_customer(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select(
        "customer_id", "first_name", "last_name", "email", "signup_date", "region", "segment"
    )


def dim_product(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(
        "product_id", "product_name", "category", "cost", "price", "margin"
    )


def date_bounds(orders: DataFrame, column: str = "order_date") -> DataFrame:
    return orders.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day from the first to the last order. The spine grows with days, not orders."""
    spine = date_bounds(orders).selectExpr("explode(sequence(min_date, max_date)) as date_day")
    return spine.select(
        "date_day",
        F.expr("cast(year(date_day) as bigint) as year"),
        F.expr("cast(month(date_day) as bigint) as month"),
        F.expr("cast(day(date_day) as bigint) as day"),
        day_of_week(F.col("date_day")).alias("day_of_week"),
        year_month(F.col("date_day")).alias("year_month"),
    )


def fct_transactions(stg_order_items: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """Order lines with their order's customer, date and state; lines without an order drop out."""
    orders = stg_orders.select("order_id", "customer_id", "order_date", "status")
    return stg_order_items.join(orders, "order_id", "inner").select(
        "order_item_id",
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        "status",
        "quantity",
        "unit_price",
        "line_amount",
    )


def with_status(df: DataFrame, status: str) -> DataFrame:
    return df.where(F.col("status") == status)


def without_status(df: DataFrame, status: str) -> DataFrame:
    return df.where(F.col("status") != status)


# Order value that counts as revenue.
COMPLETED_TOTAL = "case when status = 'completed' then order_total else 0d end"


def orders_per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders")
    )


def _one_row_per_order(orders: DataFrame, by: str, *extra: Column) -> DataFrame:
    """Collapse repeated order ids inside a group, so that counting rows counts distinct orders.

    Its shuffle key (group, order) stays even when one group holds a large share of the rows.
    """
    seen = [F.expr(f"coalesce(max(status = '{s}'), false) as any_{s}") for s in ORDER_STATUSES]
    return orders.groupBy(by, "order_id").agg(*seen, *extra)


def _status_counts() -> list[Column]:
    """Orders per state over rows that stand for one order each; a missing id is no order."""
    return [
        F.expr(f"count_if(order_id is not null and any_{s}) as {s}_orders") for s in ORDER_STATUSES
    ]


def orders_by_status(orders: DataFrame, by: str = "customer_id") -> DataFrame:
    """Distinct orders per group and state, without a row expansion per distinct count."""
    return _one_row_per_order(orders, by).groupBy(by).agg(*_status_counts())


def revenue_by(orders: DataFrame, by: str = "customer_id") -> DataFrame:
    return orders.groupBy(by).agg(exact_sum(COMPLETED_TOTAL).alias("total_revenue"))


def order_date_range_by(orders: DataFrame, by: str = "customer_id") -> DataFrame:
    return orders.groupBy(by).agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def customer_order_facts(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Counts, revenue and dates per customer.

    `unique_orders=True` asserts that order_id was checked to be unique: the distinct counts then
    need no grouping by order first, which saves one shuffle.
    """
    known = orders.where("customer_id is not null")
    if unique_orders:
        per_order = known.selectExpr(
            "customer_id",
            "order_id",
            *[f"coalesce(status = '{s}', false) as any_{s}" for s in ORDER_STATUSES],
            f"{COMPLETED_TOTAL} as revenue",
            "order_date as first_date",
            "order_date as last_date",
        )
    else:
        per_order = _one_row_per_order(
            known,
            "customer_id",
            exact_sum(COMPLETED_TOTAL).alias("revenue"),
            F.min("order_date").alias("first_date"),
            F.max("order_date").alias("last_date"),
        )
    return per_order.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        *_status_counts(),
        exact_sum("revenue").alias("total_revenue"),
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
    )


def left_with_zeros(dim: DataFrame, agg: DataFrame, on: str, zero_columns: list[str]) -> DataFrame:
    """Left join of an aggregate to a dimension, with 0 for the measures that found no match."""
    return dim.join(agg, on, "left").fillna(0, subset=zero_columns)


def mart_customer_performance(
    dim_customer: DataFrame,
    stg_orders: DataFrame,
    as_of: dt.date | None = None,
    unique_orders: bool = False,
) -> DataFrame:
    """One row per customer: order counts, revenue, ratios, first and last order, activity flag."""
    counts = ["total_orders"] + [f"{s}_orders" for s in ORDER_STATUSES]
    customers = dim_customer.select("customer_id", "first_name", "last_name", "region", "segment")
    joined = left_with_zeros(
        customers,
        customer_order_facts(stg_orders, unique_orders),
        "customer_id",
        [*counts, "total_revenue"],
    )
    return joined.select(
        *customers.columns,
        *counts,
        "total_revenue",
        safe_ratio("total_revenue", "completed_orders", 2).alias("avg_order_value"),
        safe_ratio("cancelled_orders", "total_orders", 4).alias("cancellation_rate"),
        "first_order_date",
        "last_order_date",
        is_active(F.col("last_order_date"), as_of).alias("is_active_customer"),
    )
