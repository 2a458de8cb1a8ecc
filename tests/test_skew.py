"""Plans under one hot key, and plans that must not depend on how large a side is."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions import bloom
from tillroll.operators import checks, kpis, marts, retrieval, staging
from tillroll.streaming import incremental
from tillroll.streaming.incremental import pending

N = 200_000


@pytest.fixture()
def small_thresholds(spark):
    """Make run-time skew handling act on test-sized data, with broadcasting switched off."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture()
def fct(spark, small_thresholds):
    """A third of all lines belong to order 0."""
    items = spark.range(0, N, 1, 16).select(
        F.col("id").alias("order_item_id"),
        F.expr("if(id % 3 = 0, 0, id)").alias("order_id"),
        (F.col("id") % 100).alias("product_id"),
        F.lit(1).alias("quantity"),
        (F.xxhash64("id") % 1000 / 100).alias("unit_price"),
    )
    orders = spark.range(0, N, 1, 16).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 1000).alias("customer_id"),
        F.lit(dt.date(2024, 1, 1)).alias("order_date"),
        F.lit("completed").alias("status"),
        F.lit(1.0).alias("order_total"),
    )
    return marts.fct_transactions(staging.stg_order_items(items), orders)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_is_split(spark, fct):
    assert "skew=true" in executed(fct.select("order_item_id", "status"))
    total = kpis.kpi_total_revenue(fct)
    assert "skew=true" in executed(total)
    expected = spark.range(N).agg(F.sum(F.xxhash64("id") % 1000)).first()[0] / 100
    assert total.first()[0] == expected


def test_products_meet_one_row_per_product(spark, fct):
    products = spark.range(100).select(
        F.col("id").alias("product_id"),
        F.lit("n").alias("product_name"),
        F.lit("c").alias("category"),
    )
    top = kpis.top_products(fct, products)
    assert [tuple(r)[:2] for r in top.collect()] == [("n", "c")]
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    # Below the join with products there is already an aggregate per product.
    assert plan.index("Join Inner, (product_id") < plan.index("Aggregate [product_id")


def test_orphans_of_a_hot_key_are_split(spark, fct):
    child = fct.select("order_item_id", "order_id")
    parent = spark.range(1, N).select(F.col("id").alias("order_id"))
    orphans = checks.relationships(child, "order_id", parent, "order_id")
    assert orphans.count() == sum(1 for i in range(N) if i % 3 == 0)


def test_no_vector_is_shuffled(spark, small_thresholds):
    index = spark.range(5000).selectExpr(
        "id as review_id", "array(cast(rand(1) as float), cast(rand(2) as float)) as embedding"
    )
    reviews = spark.range(5000).selectExpr("id as review_id", "1 as rating", "'t' as review_text")
    questions = spark.createDataFrame([(0, [1.0, 0.5])], "question_id long, question array<float>")
    found = retrieval.retrieve(questions, index, reviews)
    plan = executed(found)
    shuffled = [line for line in plan.split("\n") if "Exchange" in line]
    moved = [line for line in shuffled if "Broadcast" not in line]
    assert moved and not any("embedding" in line or "vectors" in line or "scores" in line for line in moved)
    assert "WindowGroupLimit" in plan


def test_many_questions_shuffle_the_index_once(spark, small_thresholds, monkeypatch):
    monkeypatch.setattr(retrieval, "QUESTION_BYTES", 100)
    monkeypatch.setattr(retrieval, "SLICE_ROWS", 1000)
    index = spark.range(5000).selectExpr("id as review_id", "array(cast(id as float), 1f) as embedding")
    reviews = spark.range(5000).selectExpr("id as review_id", "1 as rating", "'t' as review_text")
    questions = spark.range(3000).selectExpr("id as question_id", "array(cast(id as float), 2f) as question")
    plan = executed(retrieval.retrieve(questions, index, reviews)).split("Initial Plan")[0]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert len([line for line in plan.split("\n") if "Exchange hashpartitioning(slice" in line]) <= 2


def test_pending_texts_are_not_shuffled(spark, small_thresholds):
    source = spark.range(20_000).selectExpr("id as review_id", "concat('text ', id) as review_text")
    done = spark.range(0, 20_000, 3).selectExpr("id as review_id")
    found = pending(source, done, "review_id")
    plan = executed(found).split("Initial Plan")[0]
    assert not any("Exchange" in line and "review_text" in line for line in plan.split("\n"))
    assert "Exchange hashpartitioning(review_text" not in plan and "SortMergeJoin [review_id" not in plan
    assert found.count() == 13_333


@pytest.mark.parametrize("most", [0, 100_000])
def test_false_hits_are_resolved(spark, monkeypatch, most):
    """With a crowded filter nearly every row passes it; the keys decide."""
    monkeypatch.setattr(incremental, "BROADCAST_KEYS", most)
    monkeypatch.setattr(incremental, "bloom_filter", lambda df, key, n: bloom.bloom_filter(df, key, n, max_blocks=2))
    keys = "if(id % 10 = 9, null, if(id % 10 = 8, id - 1, id))"
    source = spark.range(500).selectExpr(f"{keys} as review_id", "id as __n", "'t' as review_text")
    done = spark.range(0, 500, 2).selectExpr("if(id % 7 = 0, null, id) as review_id").unionByName(spark.range(4).selectExpr("1L as review_id"))
    plain = source.join(done, "review_id", "left_anti")
    found = pending(source, done, "review_id")
    assert found.columns == source.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.select(*source.columns).collect()))
    assert pending(source, done.limit(0), "review_id").count() == 500


def test_schemas_are_declared():
    assert list(schemas.RAW_ENTITIES) == ["customers", "products", "orders", "order_items", "reviews"]
