from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions.bloom import blocks_for, bloom_filter, mark_maybe


def test_members_always_pass_and_few_strangers_do(spark):
    members = spark.range(0, 20_000)
    probes = spark.range(0, 40_000).selectExpr("if(id % 1000 = 999, null, id) as id", "id as n")
    bloom = bloom_filter(members, F.col("id"), 20_000)
    marked = mark_maybe(probes, F.col("id"), bloom, "maybe")
    found = marked.selectExpr("case when id is null then 'null' when n < 20000 then 'in' else 'out' end as side", "maybe")
    shares = {r["side"]: r["share"] for r in found.groupBy("side").agg(F.avg(F.col("maybe").cast("int")).alias("share")).collect()}
    assert shares["in"] == 1 and shares["null"] == 0 and shares["out"] < 0.1
    assert marked.columns == ["id", "n", "maybe"] and marked.count() == 40_000


def test_size_is_bounded_and_the_tested_side_is_not_shuffled(spark):
    assert blocks_for(10**12) == 1 << 20 and blocks_for(0) == 1
    members, probes = spark.range(5000), spark.range(100).select("id", F.lit("text").alias("text"))
    crowded = bloom_filter(members, F.col("id"), 5000, max_blocks=4)
    assert crowded.table.count() <= 4
    marked = mark_maybe(probes, F.col("id"), crowded, "maybe")
    assert marked.where("not maybe").count() == 0
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and "text" in line for line in plan.splitlines())


def test_texts_as_keys(spark):
    members = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    probes = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "k string")
    marked = mark_maybe(probes, F.col("k"), bloom_filter(members, F.col("k"), 3), "maybe")
    found = {r["k"]: r["maybe"] for r in marked.collect()}
    assert found["a"] and found["b"] and not found[None]
