"""Merkle manifest of a dataset, built by appending, with a witness for every row.

Every row is a leaf; the leaves of a tree (one per value of a column) are in order of id. Eight nodes next to each
other become one, the last run of a level may be shorter, until one node remains. The roots of all trees, in order
of their names, are the leaves of one more tree of the same kind.

`Appender` takes a tree's nodes one by one. It holds the runs of every level; a node's witness is the other
members of its run and of the runs above it, so a witness is partial while a run is open, and every sibling that
is completed later extends the witnesses of all leaves beside it.

Distributed, the leaves are put in order by range, counted per task, and so numbered without passing through one
place. Blocks of 8**4 aligned leaves are appended to an `Appender` each; the roots of the blocks, a 4096th of
the rows, are then appended in blocks likewise, until every tree has one root. Coming back down, each
block's witness extends those of its members. A block is one stored row, so a tree with most of the leaves is
spread over its blocks, and joins of levels meet one row per block.

Rows of one id are in order of their digests; rows alike in all are told apart by nothing and may stand in any order.
Null ids come first, and null names of trees. Null fields are leaves like others (`-`). An empty table has no
leaves and no root. Texts are hashed whole, in the JVM. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructType

from tillroll.llm.common import stored

# Members of a run, and bytes of a digest.
FANOUT, SIZE = 8, 32
# Levels that one block is reduced by.
BLOCK_LEVELS = 4

WITNESS = ArrayType(StructType().add("place", "integer").add("siblings", "binary"))


def parent_of(run: bytes) -> bytes:
    """Digest of the members' digests, end to end as hexadecimal text."""
    return hashlib.sha256(bytes(run).hex().encode()).digest()


class Appender:
    """A tree, or an aligned block of one, that grows at its end."""

    def __init__(self) -> None:
        self.levels: list[bytearray] = [bytearray()]

    def append(self, digest: bytes) -> None:
        level, run = 0, FANOUT * SIZE
        self.levels[0] += digest
        while len(self.levels[level]) % run == 0:  # the node completes its run
            if level + 1 == len(self.levels):
                self.levels.append(bytearray())
            self.levels[level + 1] += parent_of(self.levels[level][-run:])
            level += 1

    def closed(self, height: int) -> list[bytes]:
        """All levels up to `height`, with runs that are still open made into nodes; this tree stays open."""
        found: list[bytes] = [bytes(self.levels[0])]
        for level in range(1, height + 1):
            below, run = found[-1], FANOUT * SIZE
            done = bytes(self.levels[level]) if level < len(self.levels) else b""
            rest = [parent_of(below[at : at + run]) for at in range(len(done) * FANOUT, len(below), run)]
            found.append(done + b"".join(rest))
        return found


def height_of(nodes: int) -> int:
    """Levels above `nodes` nodes until one remains."""
    height = 0
    while nodes > 1:
        nodes, height = -(-nodes // FANOUT), height + 1
    return height


def siblings_of(level: bytes, at: int) -> tuple[int, bytes]:
    """A node's place in its run, and the run's other members."""
    place, first = at % FANOUT, (at - at % FANOUT) * SIZE
    run = level[first : first + FANOUT * SIZE]
    return place, run[: place * SIZE] + run[(place + 1) * SIZE :]


def witnesses(levels: Sequence[bytes]) -> list[list[tuple[int, bytes]]]:
    """Per node of the lowest level the siblings on its way to the top, which is one node."""
    paths: list[list[tuple[int, bytes]]] = [[]]
    for level in reversed(levels[:-1]):
        paths = [[siblings_of(level, at), *paths[at // FANOUT]] for at in range(len(level) // SIZE)]
    return paths


# --- leaves and their order ------------------------------------------------------------------------------------


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields end to end: `-` for a null, else the length in bytes, `:` and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered(leaves: DataFrame) -> DataFrame:
    """(tree, position, total, digest, own) of (tree, digest, own), where `own` is a struct that begins with the id.

    Rows are sorted by ranges over all tasks, also inside a tree or an id that most rows share; what a task
    has to add to its own numbers is a sum over the tasks before it.
    """
    ties = stored(leaves.withColumn("n", F.monotonically_increasing_id()), "leaves")
    id_ = F.col("own")[leaves.schema["own"].dataType.fieldNames()[0]]
    order = [F.col("tree").asc_nulls_first(), id_.asc_nulls_first(), F.col("digest").asc(), F.col("n").asc()]
    ranged = ties.repartitionByRange(*order).sortWithinPartitions(*order).drop("n")
    rows = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "ordered-leaves")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    counts = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("tree").alias("of_tree"), F.col("part").alias("of_part"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(tree).alias("total"),
    )
    starts = stored(starts, "starts")
    same = (F.col("part") == F.col("of_part")) & F.col("tree").eqNullSafe(F.col("of_tree"))
    return rows.join(starts, same).select(
        "tree", (F.col("at") + F.col("shift")).alias("position"), "total", "digest", "own"
    )


# --- blocks upwards, witnesses downwards -------------------------------------------------------------------------


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per aligned block: (tree, block, total, root, levels, own)."""
    block_levels, width = BLOCK_LEVELS, FANOUT**BLOCK_LEVELS
    schema = (
        StructType([nodes.schema["tree"]]).add("block", "long").add("total", "long").add("root", "binary")
        .add("levels", ArrayType(BinaryType())).add("own", ArrayType(nodes.schema["own"].dataType))
    )

    def pack(group: pa.Table) -> pa.Table:
        group = group.combine_chunks().take(pc.sort_indices(group.column("position")))
        tree = Appender()
        for digest in group.column("digest").to_pylist():
            tree.append(digest)
        total = group.column("total")[0].as_py()
        levels = tree.closed(min(block_levels, height_of(total)))
        own = group.column("own").combine_chunks()
        lists = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
        return pa.table({
            "tree": group.column("tree").slice(0, 1), "block": group.column("block").slice(0, 1),
            "total": pa.array([total], pa.int64()), "root": pa.array([levels[-1]], pa.binary()),
            "levels": pa.array([levels], pa.list_(pa.binary())), "own": lists,
        })

    cut = nodes.withColumn("block", F.floor(F.col("position") / width).cast("long"))
    return cut.groupBy("tree", "block").applyInArrow(pack, schema)


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of the nodes, blocks of the blocks' roots, and so on until one block per tree."""
    rounds, width = [], FANOUT**BLOCK_LEVELS
    while True:
        rounds.append(stored(_blocks(nodes), "blocks"))
        last = rounds[-1].agg(F.max("block")).first()[0]
        if not last:
            return rounds
        nodes = rounds[-1].select(
            "tree", F.col("block").alias("position"), F.ceil(F.col("total") / width).alias("total"),
            F.col("root").alias("digest"), F.struct("block").alias("own"),
        )


def _expanded(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Members of the blocks, their witnesses extended by their block's: (tree, position, digest, own, witness,
    subroot, root)."""
    blocks = blocks.drop("root", "total")
    same = (blocks["block"] == above["of_block"]) & blocks["tree"].eqNullSafe(above["of_tree"])
    rows = blocks.join(above, same).drop("of_tree", "of_block")
    own = blocks.schema["own"].dataType.elementType
    schema = (
        StructType([blocks.schema["tree"]]).add("position", "long").add("digest", "binary").add("own", own)
        .add("witness", WITNESS).add("subroot", "binary").add("root", "binary")
    )
    width = FANOUT**BLOCK_LEVELS
    kind = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.binary())]))

    def expand(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                of_block = {c: row.column(c)[0].as_py() for c in ("block", "levels", "witness", "subroot", "root")}
                levels = of_block["levels"]
                n = len(levels[0]) // SIZE
                upper = [(w["place"], w["siblings"]) for w in of_block["witness"]]
                paths = [path + upper for path in witnesses(levels)]
                flat = [step for path in paths for step in path]
                ends = np.cumsum([0] + [len(path) for path in paths]).astype(np.int32)
                steps = pa.StructArray.from_arrays(
                    [pa.array([p for p, _ in flat], pa.int32()), pa.array([s for _, s in flat], pa.binary())],
                    ["place", "siblings"],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([row.column("tree")] * n),
                     pa.array(of_block["block"] * width + np.arange(n)),
                     pa.array([levels[0][k : k + SIZE] for k in range(0, n * SIZE, SIZE)], pa.binary()),
                     row.column("own").flatten(), pa.ListArray.from_arrays(pa.array(ends), steps).cast(kind),
                     pa.array([of_block["subroot"]] * n, pa.binary()), pa.array([of_block["root"]] * n, pa.binary())],
                    schema.fieldNames(),
                )

    return rows.mapInArrow(expand, schema)


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Members of the lowest blocks with their whole witnesses. `above` has (of_tree, of_block, witness,
    subroot, root) per tree."""
    for blocks in reversed(rounds[1:]):
        members = _expanded(blocks, above)
        above = stored(members.select(
            F.col("tree").alias("of_tree"), F.col("position").alias("of_block"), "witness", "subroot", "root"
        ), "block-witnesses")
    return _expanded(rounds[0], above)


def manifest(leaves: DataFrame) -> DataFrame:
    """(tree, position, digest, own, witness, subroot, root) of every leaf of (tree, digest, own).

    `own` is a struct that begins with the id and carries what else belongs to the leaf. `witness` has one
    entry per level, from the leaf's run up to the root's: the place in the run, and the other members.
    """
    rounds = climb(numbered(leaves))
    roots = rounds[-1].select(F.lit(0).alias("tree"), F.col("root").alias("digest"), F.struct("tree").alias("own"))
    forest = climb(numbered(roots))
    nothing = F.from_json(F.lit("[]"), WITNESS)
    top = forest[-1].select(
        F.col("tree").alias("of_tree"), F.col("block").alias("of_block"), nothing.alias("witness"),
        F.col("root").alias("subroot"), "root",
    )
    trees = descend(forest, top).select(
        F.col("own.tree").alias("of_tree"), F.lit(0).cast("long").alias("of_block"), "witness",
        F.col("digest").alias("subroot"), "root",
    )
    return descend(rounds, stored(trees, "trees"))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def proof_digest(witness: Column) -> Column:
    """SHA-256 of all siblings, level by level, as hexadecimal text."""
    return F.sha2(F.array_join(F.transform(witness, lambda step: hex_text(step["siblings"])), ""), 256)


def folded(digest: Column, witness: Column) -> Column:
    """The root, as hexadecimal text, that a leaf's digest and its witness lead to."""

    def step(own: Column, level: Column) -> Column:
        others, before = hex_text(level["siblings"]), level["place"] * (2 * SIZE)
        return F.sha2(F.concat(F.substr(others, F.lit(1), before), own, F.substr(others, before + 1)), 256)

    return F.aggregate(witness, hex_text(digest), step)
