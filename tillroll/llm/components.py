"""Connected components of links between ids, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(key, label): every id in `links` (columns a, b) with the smallest id that it reaches.

    Each round gives an id the smallest among itself and its neighbours, then that one's own, and contracts
    the links to these; links within one id go. So the links shrink from round to round, and the smallest id
    of a component, which keeps itself, is what remains of it. Rounds are cut by stored tables; neighbours
    are pre-aggregated, and an id with most of the links is a join key that adaptive execution splits.
    """
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = edges.select("a").union(edges.select("b")).distinct()
    labels = nodes.select(F.col("a").alias("key"), F.col("a").alias("label"))
    edges = edges.where("a != b")
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        first = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up"))
        upper = first.select(F.col("a").alias("up"), F.col("up").alias("far"))
        to = stored(first.join(upper, "up").select(F.col("a").alias("own"), F.col("far").alias("to")), "contraction")
        of_a, of_b = to.select(F.col("own").alias("a"), F.col("to").alias("x")), to.select(F.col("own").alias("b"), F.col("to").alias("y"))
        # An id that others were contracted to may itself have moved on; that step stays a link.
        onward = to.select("to").distinct().join(to.withColumnRenamed("to", "next"), F.col("to") == F.col("own"))
        moved = edges.join(of_a, "a").join(of_b, "b").select("x", "y").union(onward.select("to", "next"))
        moved = moved.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        renamed = labels.join(to, labels["label"] == to["own"], "left")
        labels = stored(renamed.select("key", F.coalesce("to", "label").alias("label")), "labels")
        edges = stored(moved.distinct(), "edges")
    return labels
