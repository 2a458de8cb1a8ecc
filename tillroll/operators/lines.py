"""Operators on order lines: totals, first item, and the choice of orders to ask for a review."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numbers import exact_sum
from tillroll.operators.marts import without_status


def order_totals(items: DataFrame) -> DataFrame:
    """Order value from its lines."""
    total = exact_sum("quantity * unit_price")
    return items.groupBy("order_id").agg(total.alias("order_total"))


def first_item_per_order(items: DataFrame) -> DataFrame:
    """The product of each order's line with the lowest id."""
    return (
        items.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.min_by("product_id", "order_item_id").alias("product_id"))
    )


def order_first_product(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with the product of their first line; orders without lines drop out."""
    names = products.select("product_id", "product_name")
    return (
        orders.select("order_id", "customer_id", "order_date")
        .join(first_item_per_order(items), "order_id")
        .join(names, "product_id")
        .select("order_id", "customer_id", "order_date", "product_id", "product_name")
    )


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same ones for the same seed: the n lowest hashes of the key.

    Runs as a distributed top-n, without a full sort.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(order, F.asc_nulls_last(key)).limit(n)


def review_candidates(orders: DataFrame, n: int = 800, seed: int = 42) -> DataFrame:
    """A sample of the orders that were not cancelled."""
    return sample_n(without_status(orders, "cancelled"), n, "order_id", seed)
