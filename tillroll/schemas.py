"""Column names and types of the raw entities and of the two model-written tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in columns.items()])


CUSTOMERS = _struct(
    customer_id=LongType(), first_name=StringType(), last_name=StringType(), email=StringType(),
    signup_date=DateType(), region=StringType(), segment=StringType(),
)
PRODUCTS = _struct(
    product_id=LongType(), product_name=StringType(), category=StringType(),
    cost=DoubleType(), price=DoubleType(),
)
ORDERS = _struct(
    order_id=LongType(), customer_id=LongType(), order_date=DateType(), status=StringType(),
    order_total=DoubleType(),
)
ORDER_ITEMS = _struct(
    order_item_id=LongType(), order_id=LongType(), product_id=LongType(),
    quantity=IntegerType(), unit_price=DoubleType(),
)
REVIEWS = _struct(
    review_id=LongType(), order_id=LongType(), customer_id=LongType(), product_id=LongType(),
    review_date=DateType(), rating=IntegerType(), review_text=StringType(),
    true_issue_type=StringType(),
)
REVIEW_ENRICHMENT = _struct(
    review_id=LongType(), sentiment=StringType(), issue_type=StringType(), urgency=StringType(),
)
REVIEW_EMBEDDINGS = _struct(
    review_id=LongType(), embedding=ArrayType(FloatType(), containsNull=False),
)
MODEL_FAILURES = _struct(review_id=LongType(), error=StringType())

# The raw entities, in load order.
RAW_ENTITIES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "reviews": REVIEWS,
}
