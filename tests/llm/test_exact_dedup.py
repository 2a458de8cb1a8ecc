"""Exact deduplication by exchanged fingerprints, against grouping in plain Python."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import documents, edge_texts, empty_documents, prose
from pyspark.sql import functions as F

from tillroll.llm import exact_dedup, golomb


@pytest.mark.parametrize("seed", range(6))
def test_codes_come_back(seed):
    rng = np.random.default_rng(seed)
    for most in (1, 70, 10_000, 1 << 40, 1 << 62):
        for n in (0, 1, 2, 63, 64, 65, 3000):
            values = np.unique(rng.integers(0, most, n))
            assert golomb.decode(golomb.encode(values)).tolist() == values.tolist()
    dense = np.arange(500)
    assert golomb.decode(golomb.encode(dense)).tolist() == dense.tolist()
    far = np.array([0, (1 << 62) - 1])
    assert golomb.decode(golomb.encode(far)).tolist() == far.tolist()


def test_codes_are_short():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 30, 100_000))
    assert 8 * len(golomb.encode(values)) / len(values) < np.log2((1 << 30) / len(values)) + 2.2


def plain(rows) -> list[tuple]:
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    found = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        ids = sorted(ids, key=lambda i: (i is None, -(i or 0)))
        found += [(i, keep, len(ids), at == 0, sha) for at, i in enumerate(ids)]
    return sorted(found, key=repr)


def of(docs, **how) -> list[tuple]:
    found = exact_dedup.dedup(docs, **how).collect()
    shown = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in docs.collect()}
    rows = [(r["id"], r["keep_id"], r["group_size"], r["kept"], r["digest"].hex()) for r in found]
    assert {(r[0], r[4]) for r in rows} <= shown or "digest" in how
    return sorted(rows, key=repr)


def copies() -> list[str | None]:
    return [prose(1, 30)] * 40 + [prose(2, 30), prose(2, 30) + " ", prose(2, 30).upper(), prose(2, 30)] + [None, "", None] + [prose(i, 9) for i in range(60)]


@pytest.mark.parametrize("run_rows", [1 << 18, 7])
def test_equal_to_plain_grouping(spark, run_rows):
    docs = documents(spark, copies() + edge_texts(), clashing=True).repartition(5)
    assert of(docs, run_rows=run_rows) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_small_tables(spark):
    assert of(empty_documents(spark)) == []
    for texts in ([], [""], [None, None], ["a"], ["a", "a"], ["a", "b"]):
        docs = documents(spark, texts)
        assert of(docs) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_one_row_stays_of_rows_alike_in_all(spark):
    docs = spark.createDataFrame([(5, "t")] * 9 + [(None, "u")] * 4, "doc_id long, text string")
    kept = [(r["id"], r["keep_id"], r["group_size"]) for r in exact_dedup.dedup(docs).where("kept").collect()]
    assert sorted(kept, key=repr) == [(5, 5, 9), (None, None, 4)]


def test_bytes_decide_where_digests_meet(spark):
    """With a digest of the first letter alone, texts that meet in it are told apart by their bytes."""
    texts = [f"{a}{b}" for a in "abc" for b in "xyz"] * 2 + ["q1", "q1", "r1", "s"]
    docs = documents(spark, texts + [None, ""]).repartition(4)
    found = exact_dedup.dedup(docs, digest=lambda t: F.unhex(F.sha2(F.substring(t, 1, 1), 256)))
    rows = sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in found.collect()), key=repr)
    assert rows == sorted((r[:4] for r in plain([(r["doc_id"], r["text"]) for r in docs.collect()])), key=repr)


def test_suspects_are_few(spark):
    docs = documents(spark, [prose(i, 12) for i in range(3000)] + ["same"] * 500)
    rows = docs.select(F.col("doc_id").alias("id"), exact_dedup.sha256(F.coalesce("text", F.lit(""))).alias("digest"))
    judged = exact_dedup.suspects(rows, docs.count())
    assert 500 <= judged.where("suspect").count() < 600
