"""Approximate nearest neighbours by largest inner product, from a forest of random-projection trees.

Each tree halves a bounded sample of the vectors by the median of their projection on the line through two
of its points, again and again; the splits are then applied to every vector, so all are in the index. A
query opens leaves of all trees from one priority queue, nearest splits first, until its share of leaves is
used. What lies in them is scored exactly, and the best are ranked on the original vectors in double
precision.

Vectors are grouped by value first: copies share one class, which keeps the smallest ids that a result can
name, so neither a leaf nor a result is filled by copies and none is lost. Null, empty and zero vectors,
those holding a null or a number that is not finite, and those of another length than most take no part.
Rows that repeat an id count once per distinct vector. Ties go to the smaller id. An empty table gives no
rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import stored

# The trees are built from at most so many vectors, those whose hashes are least.
SAMPLE = 16_384
TREES = 6
# Vectors in a leaf, as far as the sample allows; a leaf's sample is no smaller than LEAST_SAMPLE. Small
# tables get smaller leaves, down to that size, until a tree has 2 ** SHALLOW of them.
LEAF, LEAST_SAMPLE, SHALLOW = 400, 16, 5
# Share of all leaves that a query may open: high, as in 64 dimensions without much structure recall is
# bought by looking. Measured recall at 20 is in the README.
SEARCH_SHARE = 0.25
# A task's piece of a leaf: vectors and queries at most, about.
BLOCK_VECTORS, BLOCK_QUERIES = 2048, 1024
# Queries whose leaves a task looks for: no fewer than the one, so far as the session's shuffle partitions allow,
# and no more than the other.
LEAST_ASKED, MOST_ASKED = 256, 65_536


@dataclass
class Forest:
    """Complete binary trees: split i has children 2i + 1 and 2i + 2; leaves are numbered from 0."""

    normals: np.ndarray  # trees x splits x dimensions
    limits: np.ndarray  # trees x splits
    depth: int

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of every vector in every tree, numbered across trees."""
        found = np.zeros((len(vectors), len(self.normals)), np.int64)
        for tree in range(len(self.normals)):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                side = np.einsum("nd,nd->n", vectors, self.normals[tree][node]) > self.limits[tree][node]
                node = 2 * node + 1 + side
            found[:, tree] = node - (self.leaves - 1) + tree * self.leaves
        return found

    def open_leaves(self, query: np.ndarray, budget: int) -> list[int]:
        """The `budget` leaves across all trees with the smallest summed squares of passed margins."""
        margins = (self.normals @ query - self.limits).tolist()
        inner = self.leaves - 1
        queue = [(0.0, tree, 0) for tree in range(len(margins))]
        found: list[int] = []
        while queue and len(found) < budget:
            cost, tree, node = heapq.heappop(queue)
            own = margins[tree]
            while node < inner:
                margin = own[node]
                near = 2 * node + 1 + (margin > 0)
                far = 2 * node + 1 + (margin <= 0)
                heapq.heappush(queue, (cost + margin * margin, tree, far))
                node = near
            found.append(node - inner + tree * self.leaves)
        return found


def build_forest(sample: np.ndarray, total: int, trees: int = TREES, leaf: int = LEAF, seed: int = 5) -> Forest:
    rng = np.random.default_rng(seed)
    deepest = max(0, int(np.log2(max(1, len(sample) / LEAST_SAMPLE))))
    depth = min(deepest, max(SHALLOW, round(np.log2(max(1, total / leaf)))))
    splits = (1 << depth) - 1
    normals = np.zeros((trees, splits, sample.shape[1]))
    limits = np.zeros((trees, splits))
    for tree in range(trees):
        node = np.zeros(len(sample), np.int64)
        for split in range(splits):
            own = np.flatnonzero(node == split)
            if len(own) >= 2:
                a, b = rng.choice(own, 2, replace=False)
                line = sample[a] - sample[b]
            else:
                line = rng.normal(size=sample.shape[1])
            line = line / (np.linalg.norm(line) + 1e-300)
            normals[tree, split] = line
            if len(own):
                along = sample[own] @ line
                limits[tree, split] = np.median(along)
                node[own] = 2 * split + 1 + (along > limits[tree, split])
    return Forest(normals, limits, depth)


def _usable(vector: Column) -> Column:
    def good(x):
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    return vector.isNotNull() & F.forall(vector, good) & F.exists(vector, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component, so equal pairs score equally anywhere."""
    total = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        total = total + queries[:, d] * vectors[:, d]
    return total


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    sample: int = SAMPLE, trees: int = TREES, leaf: int = LEAF, share: float = SEARCH_SHARE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the `k` nearest found for every row that `queries` marks."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), queries.alias("asks")
    ).where(F.col("id").isNotNull() & _usable(F.col("v")))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if length is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("v") == length["n"])
    # A class per distinct vector, named by its smallest id. A result can name k of its ids beside the query's.
    by_vector = Window.partitionBy("v").orderBy("id")
    members = (
        rows.groupBy("v", "id").agg(F.max("asks").alias("asks"))
        .withColumn("place", F.row_number().over(by_vector)).where(F.col("place") <= k + 1)
    )
    classes = stored(members.groupBy("v").agg(F.min("id").alias("class"), F.array_sort(F.collect_list("id")).alias("ids")), "vector-classes")
    asked = rows.where("asks").groupBy("v", "id").agg(F.lit(1).alias("one")).select("v", "id")
    asked = stored(asked.join(classes.select("v", "class"), "v").select("id", "class"), "vector-queries")
    total = classes.count()
    few = classes.select("v").orderBy(F.xxhash64("v")).limit(sample)
    known = np.array([r["v"] for r in few.collect()], np.float64)  # bounded by `sample`
    forest = build_forest(known, total, trees, leaf)
    budget = max(1, round(share * trees * forest.leaves))
    shared = vectors.sparkSession.sparkContext.broadcast((forest, known.astype(np.float32), forest.leaf_of(known)))

    def index(batches):
        for batch in batches:
            found = shared.value[0].leaf_of(_matrix(batch["v"]))
            at = np.repeat(np.arange(len(found)), found.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.ravel()), batch["class"].take(pa.array(at)), batch["v"].take(pa.array(at))], ["cell", "class", "v"]
            )

    def ask(batches):
        """Opened leaves of the queries, and a score that the k best in them reach: the sample's own vectors
        in those leaves show it."""
        forest, known, leaves_of_known = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                own = batch.slice(low, 64)
                q = _matrix(own["v"])
                scores = q @ known.T.astype(np.float64)
                opened = [forest.open_leaves(x, budget) for x in q]
                floor = np.full(len(q), -np.inf)
                for i, leaves in enumerate(opened):
                    is_open = np.zeros(trees * forest.leaves, bool)
                    is_open[leaves] = True
                    inside = scores[i, is_open[leaves_of_known].any(axis=1)]
                    if len(inside) > k:  # the query itself may be in the sample, so one more is counted
                        floor[i] = np.partition(inside, -k - 1)[-k - 1] - 1e-5
                at = np.repeat(np.arange(len(opened)), [len(o) for o in opened])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(opened).astype(np.int64)), own["class"].take(pa.array(at)),
                     own["v"].take(pa.array(at)), pa.array(floor[at])], ["cell", "class", "v", "floor"],
                )

    kind = rows.schema["v"].dataType.simpleString()
    shape = f"cell long, class long, v {kind}"
    indexed = stored(classes.select("class", "v").mapInArrow(index, shape), "vector-leaves")
    asking = classes.join(asked.select("class").distinct(), "class", "left_semi").select("class", "v")
    n_asked = asked.count()
    usual = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(usual, -(-n_asked // LEAST_ASKED)), -(-n_asked // MOST_ASKED))
    probes = stored(asking.repartition(tasks, F.col("class")).mapInArrow(ask, f"{shape}, floor double"), "vector-probes")

    # Large leaves are cut into blocks: sizes of all cells, at most trees x leaves rows.
    def sizes(df: DataFrame, block: int) -> DataFrame:
        return df.groupBy("cell").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / block)).cast("int").alias("parts"))

    parts_v, parts_q = sizes(indexed, BLOCK_VECTORS), sizes(probes, BLOCK_QUERIES)
    both = F.broadcast(parts_v.withColumnRenamed("parts", "pv").join(parts_q.withColumnRenamed("parts", "pq"), "cell"))

    def blocks(df: DataFrame, own: str, other: str, *more: str) -> DataFrame:
        dealt = df.join(both, "cell").withColumn("mine", F.pmod(F.xxhash64("class"), F.col(own)).cast("int"))
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        named = dealt.select("cell", "class", "v", *more, "mine", every.alias("theirs"))
        first, second = ("mine", "theirs") if own == "pv" else ("theirs", "mine")
        return named.select("cell", F.col(first).alias("bv"), F.col(second).alias("bq"), "class", "v", *more)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"query": pa.array([], pa.int64()), "class": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return none
        of_query, q = right["class"].to_numpy(), _matrix(right["v"])
        of_vector, v = left["class"].to_numpy(), _matrix(left["v"])
        rough = q @ v.T
        limit = right["floor"].to_numpy()
        if len(of_vector) > k + 1:
            limit = np.maximum(limit, np.partition(rough, -k - 1, axis=1)[:, -k - 1] - 1e-9)
        a, b = np.nonzero(rough >= limit[:, None])
        return pa.table({"query": of_query[a], "class": of_vector[b], "score": exact_scores(q[a], v[b])})

    pairs = (
        blocks(indexed, "pv", "pq").groupBy("cell", "bv", "bq")
        .cogroup(blocks(probes, "pq", "pv", "floor").groupBy("cell", "bv", "bq"))
        .applyInArrow(score, "query long, class long, score double")
    )
    pairs = pairs.groupBy("query", "class").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    best = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    named = best.join(classes.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    short = named.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
    lists = short.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("hits"))
    own = asked.join(lists, asked["class"] == lists["query"])
    kept = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("id")), 1, k)
    ranked = own.select(F.col("id").alias("query_id"), F.posexplode(kept).alias("at", "hit"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score")
    )
