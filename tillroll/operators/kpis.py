"""Dashboard figures and the documented business questions, over gold tables.

Fact rows are summed per key before a dimension is joined, so that only one row per key meets the
dimension and a key with very many lines collapses before any shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import as_of_date, year_month
from tillroll.functions.numbers import exact_mean, exact_sum, safe_ratio
from tillroll.operators.marts import with_status


def completed_transactions(fct: DataFrame) -> DataFrame:
    return with_status(fct, "completed")


def kpi_total_revenue(fct: DataFrame) -> DataFrame:
    total = F.coalesce(exact_sum("line_amount"), F.lit(0.0))
    return completed_transactions(fct).agg(total.alias("total_revenue"))


def kpi_aov(orders: DataFrame) -> DataFrame:
    """Mean order total of completed orders."""
    mean = F.coalesce(exact_mean("order_total"), F.lit(0.0))
    return with_status(orders, "completed").agg(mean.alias("avg_order_value"))


def kpi_cancellation_rate(mart: DataFrame) -> DataFrame:
    """Unweighted mean of the customers' rates; customers without orders count as 0."""
    mean = F.coalesce(exact_mean("cancellation_rate", 4), F.lit(0.0))
    return mart.agg(mean.alias("cancellation_rate"))


def order_cancellation_rate(orders: DataFrame) -> DataFrame:
    """Cancelled orders over all orders."""
    share = safe_ratio("count_if(status = 'cancelled')", "count(*)", 4)
    return orders.agg(share.alias("cancellation_rate"))


def active_only(mart: DataFrame) -> DataFrame:
    return mart.where("is_active_customer")


def kpi_active_customers(mart: DataFrame) -> DataFrame:
    return active_only(mart).agg(F.count("*").alias("active_customers"))


def kpi_summary(fct: DataFrame, orders: DataFrame, mart: DataFrame) -> DataFrame:
    """The four headline figures in one row, with their display texts.

    The mart is read once for both of its figures. The three one-row results are put side by side
    as scalar subqueries, without a join.
    """
    per_customer = mart.agg(
        F.struct(
            F.coalesce(exact_mean("cancellation_rate", 4), F.lit(0.0)).alias("rate"),
            F.count_if("is_active_customer").alias("active"),
        ).alias("figures")
    )
    figures = fct.sparkSession.range(1).select(
        kpi_total_revenue(fct).scalar().alias("total_revenue"),
        kpi_aov(orders).scalar().alias("avg_order_value"),
        per_customer.scalar().alias("mart"),
    )
    summary = figures.selectExpr(
        "total_revenue",
        "avg_order_value",
        "mart.rate as cancellation_rate",
        "mart.active as active_customers",
    )
    return summary.selectExpr(
        "*",
        "'$' || format_number(total_revenue, 0) as total_revenue_text",
        "'$' || format_number(avg_order_value, 2) as avg_order_value_text",
        "format_number(cancellation_rate * 100, 1) || '%' as cancellation_rate_text",
        "format_number(active_customers, 0) as active_customers_text",
    )


def _revenue_per(fct: DataFrame, key: str) -> DataFrame:
    return completed_transactions(fct).groupBy(key).agg(
        exact_sum("line_amount").alias("key_revenue")
    )


def revenue_by_product(fct: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Completed revenue per product name and category; products of one name are taken together."""
    return (
        _revenue_per(fct, "product_id")
        .join(dim_product.select("product_id", "product_name", "category"), "product_id")
        .groupBy("product_name", "category")
        .agg(exact_sum("key_revenue").alias("revenue"))
    )


def revenue_by_product_id(fct: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Completed revenue per product."""
    return (
        _revenue_per(fct, "product_id")
        .join(dim_product.select("product_id", "product_name", "category"), "product_id")
        .select("product_id", "product_name", "category", F.col("key_revenue").alias("revenue"))
    )


def top_products(fct: DataFrame, dim_product: DataFrame, n: int = 10) -> DataFrame:
    ties = [F.asc_nulls_last("product_name"), F.asc_nulls_last("category")]
    return (
        revenue_by_product(fct, dim_product)
        .orderBy(F.desc_nulls_last("revenue"), *ties)
        .limit(n)
    )


def revenue_by_region(fct: DataFrame, dim_customer: DataFrame, n: int | None = 5) -> DataFrame:
    by_region = (
        _revenue_per(fct, "customer_id")
        .join(dim_customer.select("customer_id", "region"), "customer_id")
        .groupBy("region")
        .agg(exact_sum("key_revenue").alias("revenue"))
    )
    if n is None:
        return by_region
    return by_region.orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("region")).limit(n)


def revenue_by_month(fct: DataFrame) -> DataFrame:
    """Completed revenue per calendar month; lines without a date belong to none."""
    return (
        completed_transactions(fct)
        .where(F.col("order_date").isNotNull())
        .groupBy(year_month(F.col("order_date")).alias("year_month"))
        .agg(exact_sum("line_amount").alias("revenue"))
    )


def revenue_by_stored_month(stored: DataFrame, month: str) -> DataFrame:
    """As `revenue_by_month`, of lines that are stored by month: the month is read off the folders' names."""
    dated = completed_transactions(stored).where(F.col(month).isNotNull())
    return dated.groupBy(F.col(month).alias("year_month")).agg(exact_sum("line_amount").alias("revenue"))


def revenue_last_month(fct: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Completed revenue of the month before `as_of`, as one row; the date range is pushed down."""
    this_month = F.trunc(as_of_date(as_of), "month")
    last_month = F.add_months(this_month, -1)
    in_range = (F.col("order_date") >= last_month) & (F.col("order_date") < this_month)
    revenue = F.coalesce(exact_sum("line_amount"), F.lit(0.0)).alias("revenue")
    total = completed_transactions(fct).where(in_range).agg(revenue)
    return total.select(year_month(last_month).alias("year_month"), "revenue")


def aov_by_region(mart: DataFrame) -> DataFrame:
    """Mean of the customers' average order values."""
    return mart.groupBy("region").agg(
        exact_mean("avg_order_value").alias("avg_order_value")
    )


def cancellation_hotspots(mart: DataFrame) -> DataFrame:
    return mart.groupBy("region", "segment").agg(
        exact_mean("cancellation_rate", 4).alias("cancellation_rate")
    )


def complaints_by_issue(enrichment: DataFrame) -> DataFrame:
    return enrichment.groupBy("issue_type").agg(F.count("*").alias("reviews"))
