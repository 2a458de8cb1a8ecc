"""The models by name: staging and gold relations built from the raw entities."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from tillroll.operators import marts, staging

Tables = Mapping[str, DataFrame]

# The gold relations, in build order.
GOLD_TABLES = (
    "dim_customer", "dim_product", "dim_date", "fct_transactions", "mart_customer_performance",
)

# Columns that reports filter on: stored files are sorted by them.
SORT_BY = {"fct_transactions": ("order_date",)}


def build_staging(raw: Tables) -> dict[str, DataFrame]:
    """Staging relations of the raw entities that are there."""
    builders = {
        "customers": staging.stg_customers,
        "products": staging.stg_products,
        "orders": staging.stg_orders,
        "order_items": staging.stg_order_items,
        "reviews": staging.stg_reviews,
    }
    return {f"stg_{name}": build(raw[name]) for name, build in builders.items() if name in raw}


def register_staging(tables: Tables) -> None:
    """Make staging relations known to SQL as lazy views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def build_gold(
    stg: Tables, as_of: dt.date | None = None, unique_orders: bool = False
) -> dict[str, DataFrame]:
    """Gold relations over staging; pass `unique_orders` once order ids are checked."""
    customers = marts.dim_customer(stg["stg_customers"])
    return {
        "dim_customer": customers,
        "dim_product": marts.dim_product(stg["stg_products"]),
        "dim_date": marts.dim_date(stg["stg_orders"]),
        "fct_transactions": marts.fct_transactions(stg["stg_order_items"], stg["stg_orders"]),
        "mart_customer_performance": marts.mart_customer_performance(
            customers, stg["stg_orders"], as_of, unique_orders
        ),
    }
