"""The Merkle manifest against trees built whole in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from helpers import documents, edge_texts, empty_documents
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillroll.llm import merkle

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves: list[str]) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """Root, and per leaf (place, siblings) of every level."""
    paths, nodes, owners = [[] for _ in leaves], leaves, [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        higher, their = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for place in range(len(run)):
                for leaf in owners[at + place]:
                    paths[leaf].append((place, run[:place] + run[place + 1 :]))
            higher.append(sha("".join(run)))
            their.append(sum(owners[at : at + 8], []))
        nodes, owners = higher, their
    return nodes[0], paths


def leaf(row, fold: bool = False) -> str:
    text = row["text"].translate(FOLD) if fold and row["text"] is not None else row["text"]
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain(rows) -> list[tuple]:
    by_lang: dict = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for own in by_lang.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {x: plain_tree([leaf(r) for r in by_lang[x]]) for x in langs}
    root, upper = plain_tree([trees[x][0] for x in langs]) if langs else (None, [])
    found = []
    for x, above in zip(langs, upper):
        for r, path in zip(by_lang[x], trees[x][1]):
            seen = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            own = leaf(r, fold=seen)
            for place, others in path + above:
                own = sha("".join(others[:place]) + own + "".join(others[place:]))
            proof = sha("".join("".join(others) for _, others in path + above))
            found.append((r["doc_id"], leaf(r), trees[x][0], root, proof, own, own == root))
    return sorted(found, key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 73, 513])
def test_appended_tree(n):
    """After every append the witnesses of all earlier leaves lead to the root of what there is."""
    tree, digests = merkle.Appender(), [sha(str(i)) for i in range(n)]
    for k, digest in enumerate(digests, start=1):
        tree.append(bytes.fromhex(digest))
        if k < 20 or k == n:
            levels = tree.closed(merkle.height_of(k))
            root, paths = plain_tree(digests[:k])
            assert levels[-1].hex() == root
            own = [[(p, s.hex()) for p, s in path] for path in merkle.witnesses(levels)]
            assert own == [[(p, "".join(s)) for p, s in path] for path in paths]


def query(spark, docs, tmp_path):
    docs.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    found = entry.queries()["op11_merkle"](spark, str(tmp_path))
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 4])
def test_equal_to_whole_trees(spark, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    texts = edge_texts() + [f"Text Number {i}" for i in range(150)]
    lang = F.expr("case when doc_id % 11 = 3 then null when doc_id = 20 then 'ü' when doc_id % 3 = 0 then 'de' else 'en' end")
    docs = documents(spark, texts, clashing=True).withColumn("lang", lang).repartition(4)
    got = query(spark, docs, tmp_path)
    assert got == plain(docs.collect())
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_small_tables(spark, tmp_path):
    assert query(spark, empty_documents(spark), tmp_path / "none") == []
    one = documents(spark, ["Alone"]).where("doc_id = 0").limit(1)
    assert query(spark, one, tmp_path / "one") == plain(one.collect())


def test_a_tree_with_nearly_all_rows_is_numbered_in_many_tasks(spark):
    rows = spark.range(5000).select(
        F.lit("en").alias("tree"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"),
        F.struct(F.lit(7).alias("id")).alias("own"),
    )
    found = merkle.numbered(rows)
    assert sorted(r["position"] for r in found.select("position").collect()) == list(range(5000))
    assert found.select("total").distinct().collect()[0][0] == 5000
