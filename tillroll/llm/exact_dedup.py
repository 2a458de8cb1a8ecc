"""Exact duplicates of whole texts, found by exchanging Golomb-coded fingerprints.

1. Every task cuts its rows into runs. A run's distinct fingerprints, the leading bits of the texts' digests,
   are sorted and sent to their owners, one Golomb-coded message per run and owner. Owners share the range of
   fingerprints evenly; a fingerprint that fills a run goes out once, so no copy group makes an owner hot.
2. An owner answers each message with a bitmap: which of its fingerprints came in other messages too. Rows
   whose fingerprint stands twice in their own run, or is so marked, are suspects; all others are alone.
3. Texts of suspects, and of the few that a Bloom filter of bounded size takes for them, are merged within
   each task and then shuffled by digest and text, where equality is decided by the bytes. Texts of a digest
   that stands for more than one text are grouped by the texts themselves; with SHA-256 there are none.

Only ids and digests are stored, never texts. Groups that hold more than a thousandth of the suspects (so at
most a thousand groups) are broadcast to the rows, all others are joined by digest: no key meets one task.

Null texts count as empty ones, which are equal to each other. Of equal texts the row with the largest id stays;
null ids come after all others; of rows alike in text and id, one stays. Other columns are not read, so their
names do not matter. An empty table gives no rows. A text is never cut; the longest one must fit a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.bloom import bloom_filter, mark_maybe
from tillroll.llm import golomb
from tillroll.llm.common import schema_with, stored

# A fingerprint has so many bits more than it takes to number all rows: one lone row in 2**7 is a false suspect.
SPARE_BITS = 7
# Rows of a run, held by a worker at once, and fingerprints of an owner. At least so many owners share the work.
RUN_ROWS, OWNER_KEYS, LEAST_OWNER_BITS = 1 << 18, 1 << 22, 4
# Groups with at least this share of all suspects are broadcast to their rows; there are 1000 at most.
HOT_SHARE = 1000

SENT = "part long, place long, owner int, slot int, twice boolean, id {id}, digest binary, code binary"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def prefixes(digests: pa.Array, bits: int) -> np.ndarray:
    """The first `bits` bits of each digest."""
    heads = b"".join(d[:8] for d in digests.to_pylist())
    return (np.frombuffer(heads, ">u8") >> np.uint64(64 - bits)).astype(np.int64)


def _messages(rows: DataFrame, bits: int, owner_bits: int, run_rows: int) -> DataFrame:
    """All rows with the place of their fingerprint in its message, and the messages, one row each."""
    names = ["part", "place", "owner", "slot", "twice", "id", "digest", "code"]
    schema = SENT.format(id=rows.schema["id"].dataType.simpleString())

    def sent(run: pa.Table, part: int) -> Iterator[pa.RecordBatch]:
        ids, digests = (c.combine_chunks() for c in run.columns)
        own, slot, copies = np.unique(prefixes(digests, bits), return_inverse=True, return_counts=True)
        owner = (own >> (bits - owner_bits)).astype(np.int32)
        first = np.searchsorted(owner, owner, side="left")
        n = len(slot)

        def nulls(length: int, kind: pa.DataType) -> pa.Array:
            return pa.nulls(length, kind)

        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part)), pa.array((part << 20) + np.arange(n)), pa.array(owner[slot]),
             pa.array((slot - first[slot]).astype(np.int32)), pa.array(copies[slot] > 1), ids, digests,
             nulls(n, pa.binary())], names,
        )
        begins = np.unique(first)
        codes = [golomb.encode(own[a:b] - (int(owner[a]) << (bits - owner_bits))) for a, b in zip(begins, [*begins[1:], len(own)])]
        m = len(begins)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, part)), nulls(m, pa.int64()), pa.array(owner[begins]), nulls(m, pa.int32()),
             nulls(m, pa.bool_()), nulls(m, ids.type), nulls(m, pa.binary()), pa.array(codes, pa.binary())], names,
        )

    def run(batches):
        held, size, part = [], 0, TaskContext.get().partitionId() << 20
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, run_rows - size))
                batch, size = batch.slice(held[-1].num_rows), size + held[-1].num_rows
                if size == run_rows:
                    yield from sent(pa.Table.from_batches(held), part)
                    held, size, part = [], 0, part + 1
        if held:
            yield from sent(pa.Table.from_batches(held), part)

    return rows.mapInArrow(run, schema)


def _answers(messages: DataFrame) -> DataFrame:
    """(part, owner, words): per message the bits of fingerprints that other messages hold too. Messages
    without any get no answer."""

    def answer(group: pa.Table) -> pa.Table:
        own = [golomb.decode(code) for code in group.column("code").to_pylist()]
        _, at, copies = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        ends = np.cumsum([len(x) for x in own])
        parts, words = [], []
        for part, end, values in zip(group.column("part").to_pylist(), ends, own):
            shared = copies[at[end - len(values) : end]] > 1
            if shared.any():
                padded = np.zeros(-(-len(shared) // 64) * 64, np.uint8)
                padded[: len(shared)] = shared
                parts.append(part)
                words.append(np.packbits(padded, bitorder="little").view("<i8").tolist())
        owner = group.column("owner").to_pylist()[:1] * len(parts)
        return pa.table({
            "part": pa.array(parts, pa.int64()), "owner": pa.array(owner, pa.int32()),
            "words": pa.array(words, pa.list_(pa.int64())),
        })

    return messages.groupBy("owner").applyInArrow(answer, "part long, owner int, words array<long>")


def suspects(rows: DataFrame, n_rows: int, run_rows: int = RUN_ROWS) -> DataFrame:
    """(id, digest, place, suspect) of every row of (id, digest)."""
    bits = min(62, n_rows.bit_length() + SPARE_BITS)
    owner_bits = min(bits, max(LEAST_OWNER_BITS, (n_rows // OWNER_KEYS).bit_length()))
    sent = stored(_messages(rows, bits, owner_bits, run_rows), "fingerprints")
    answers = _answers(sent.where("code is not null").select("part", "owner", "code"))
    own = sent.where("code is null").drop("code").join(stored(answers, "answers"), ["part", "owner"], "left")
    word = F.get("words", F.shiftright("slot", 6))
    bit = F.call_function("shiftrightunsigned", word, F.col("slot").bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1))
    marked = own.select("id", "digest", "place", (F.col("twice") | F.coalesce(bit == 1, F.lit(False))).alias("suspect"))
    return stored(marked, "suspects")


def _grouped(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per key the row that stays and the number of rows, of keys with more than one."""
    top = F.max(F.struct("id", "place")).alias("top")
    return rows.groupBy(*by).agg(top, F.count(F.lit(1)).alias("n")).where("n > 1")


def _outcome(rows: DataFrame) -> DataFrame:
    """Result rows of (id, digest, place) next to `top` and `n`, which are null for rows that are alone."""
    mine = F.col("top").isNull()
    return rows.select(
        "id",
        F.when(mine, F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (mine | (F.col("place") == F.col("top.place"))).alias("kept"),
        "digest",
    )


def _joined(rows: DataFrame, groups: DataFrame, n_rows: int, by: list[str]) -> DataFrame:
    """Outcome of the rows, each next to its group if it has one. Large groups, at most HOT_SHARE of them, are broadcast."""
    least = max(2, -(-n_rows // HOT_SHARE))
    large = rows.join(F.broadcast(groups.where(F.col("n") >= least)), by, "left")
    rest = large.where("top is null").select(*rows.columns).join(groups.where(F.col("n") < least), by, "left")
    return _outcome(large.where("top is not null")).unionByName(_outcome(rest))


def dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) of every row. `digest` makes at least eight bytes of a text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), digest(text).alias("digest"))
    judged = suspects(rows, df.count(), run_rows)
    likely = judged.where("suspect").select("id", "digest", "place")
    groups = stored(_grouped(likely, ["digest"]), "groups")
    n_groups, n_likely = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    nothing = [F.lit(None).cast(groups.schema[c].dataType).alias(c) for c in ("top", "n")]
    alone = _outcome(judged.where("not suspect").select("id", "digest", "place", *nothing))
    if not n_groups:  # chance meetings of fingerprints alone
        return alone.unionByName(_outcome(likely.select("*", *nothing)))
    # The bytes decide: texts of each digest, merged within tasks before they are shuffled.
    whole = df.select(F.col(id_col).alias("id"), digest(text).alias("digest"), text.alias("text"))
    bloom = bloom_filter(groups, F.col("digest"), n_groups)
    seen = mark_maybe(whole.select("digest", "text"), F.col("digest"), bloom, "__maybe").where("__maybe")
    texts = seen.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"))
    counted = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n_texts"))
    mixed = stored(counted.where("n_texts > 1").select("digest"), "mixed-digests")
    if mixed.isEmpty():
        return alone.unionByName(_joined(likely, groups, n_likely, ["digest"]))
    # Digests that stand for several texts: their rows are grouped by the texts.
    sure = _joined(likely.join(mixed, "digest", "left_anti"), groups, n_likely, ["digest"])
    own = whole.join(mixed, "digest", "left_semi").withColumn("place", F.monotonically_increasing_id())
    own = stored(own, "mixed-rows")
    by_text = stored(_grouped(own, ["digest", "text"]), "mixed-groups")
    return alone.unionByName(sure).unionByName(_joined(own, by_text, n_likely, ["digest", "text"]))
