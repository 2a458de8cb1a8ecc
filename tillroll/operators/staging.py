"""Silver layer: one cleaned relation per raw entity. Rows without a key are dropped, no others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numbers import round_half_up


def require_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(f"{key} is not null")


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return require_key(raw_customers, "customer_id").selectExpr(
        "customer_id",
        "trim(first_name) as first_name",
        "trim(last_name) as last_name",
        "lower(trim(email)) as email",
        "signup_date",
        "region",
        "segment",
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    return require_key(raw_products, "product_id").select(
        "product_id",
        F.expr("trim(product_name) as product_name"),
        "category",
        "cost",
        "price",
        round_half_up("price - cost", 2).alias("margin"),
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return require_key(raw_orders, "order_id").select(
        "order_id", "customer_id", "order_date", "status", "order_total"
    )


def stg_order_items(raw_order_items: DataFrame) -> DataFrame:
    return require_key(raw_order_items, "order_item_id").select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        round_half_up("quantity * unit_price", 2).alias("line_amount"),
    )


def stg_reviews(raw_reviews: DataFrame) -> DataFrame:
    return require_key(raw_reviews, "review_id").selectExpr(
        "review_id",
        "order_id",
        "customer_id",
        "product_id",
        "review_date",
        "rating",
        "trim(review_text) as review_text",
    )
