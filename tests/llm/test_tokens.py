"""Sharding, BPE and token files."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from helpers import documents, empty_documents, found
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import bpe, pretokens, sharding, token_files

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def turns(shards, size):
    """The table filled turn by turn from whole preference lists."""
    lists = []
    for name in shards:
        start, stride = sharding._number(f"start {name}") % size, sharding._number(f"stride {name}") % (size - 1) + 1
        lists.append([(start + i * stride) % size for i in range(size)])
    owner = {}
    while len(owner) < size:
        for i, preferred in enumerate(lists):
            if len(owner) < size:
                owner[next(s for s in preferred if s not in owner)] = i
    return [owner[s] for s in range(size)]


def test_shard_table_equals_the_plain_one_and_is_even():
    shards = [f"s{i}" for i in range(7)]
    table = sharding.fill_table(shards, 211)
    assert table == turns(shards, 211)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.fill_table(shards[:-1], 211)
    stayed = sum(a == b for a, b in zip(table, fewer) if a != 6)
    assert stayed > 0.7 * sum(a != 6 for a in table)
    with pytest.raises(ValueError):
        sharding.fill_table(shards, 210)


def test_every_row_is_placed_by_its_key(spark):
    docs = documents(spark, clashing=True)
    placed = sharding.assign(docs, F.col("doc_id"), ["a", "b", "c"], 101)
    assert placed.count() == docs.count() and set(docs.columns) <= set(placed.columns)
    table = sharding.fill_table(["a", "b", "c"], 101)
    for row in placed.collect():
        text = "null" if row["doc_id"] is None else f"={row['doc_id']}"
        slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 101
        assert (row["slot"], row["shard"]) == (slot, "abc"[table[slot]])
    assert sharding.assign(empty_documents(spark), F.col("doc_id"), ["a"], 101).count() == 0


def test_cuts_equal_the_pattern():
    rng = random.Random(3)
    parts = [" ", "  ", "'", "s", "t", "re", "ve", "ll", "a", "é", "1", "²", "\n", "\t", " ", "　", "!", "中", "\x1c", "\x85", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    pattern = regex.compile(public_tokenizers.PATTERN)
    tokens, counts = pretokens.cut(pa.array(texts))
    tokens, at = tokens.to_pylist(), 0
    for text, count in zip(texts, counts):
        assert tokens[at : at + count] == pattern.findall(text)
        at += count


def test_transducer_equals_the_library(library):
    transducer = bpe.Transducer(bpe.read_ranks(RANKS))
    rng = random.Random(1)
    for i in range(4000):
        letters = b"aaaabcdeth ingzxq-=.." if i % 5 else bytes(range(256))
        data = bytes(rng.choice(letters) for _ in range(rng.randint(1, 60)))
        tokens = transducer.encode(data)
        assert tokens == library._encode_single_piece(data)
        if i % 8 == 0:
            assert list(transducer.stream(data)) == tokens


def test_stream_sends_tokens_before_the_end():
    transducer = bpe.Transducer(bpe.read_ranks(RANKS))
    read = 0

    def letters():
        nonlocal read
        for byte in b"thequickbrownfoxjumps" * 50:
            read += 1
            yield byte

    next(transducer.stream(letters()))
    assert read < 200


def test_utf8_stream_holds_back_unfinished_characters():
    text = "aé中😀" * 3
    data = text.encode()
    for step in (1, 2, 3, 5):
        stream = bpe.Utf8Stream()
        assert "".join(stream.feed(data[i : i + step]) for i in range(0, len(data), step)) + stream.close() == text
    stream = bpe.Utf8Stream()
    assert stream.feed(b"a\xe4\xb8") + stream.close() == b"a\xe4\xb8".decode("utf-8", "replace")


def test_encode_and_decode(spark, library):
    docs = documents(spark, clashing=True)
    coded = bpe.encode(docs, RANKS, ["doc_id", "text", "key"])
    for row in coded.collect():
        assert row["token_ids"] == library.encode_ordinary(row["text"] or "") and row["n_tokens"] == len(row["token_ids"])
    back = bpe.decode(coded, RANKS, ["doc_id", "n_tokens"])
    assert found(back.select("doc_id", "text")) == found(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    assert bpe.encode(empty_documents(spark), RANKS, ["doc_id"]).count() == 0


def test_round_trip_digests(spark, library):
    for row in bpe.round_trip(documents(spark), RANKS).join(documents(spark).distinct(), "doc_id").collect():
        ids = np.array(library.encode_ordinary(row["text"] or ""), "<u4")
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    for width in (1, 7, 16, 17, 31, 32):
        for n in (0, 1, 63, 64, 65, 1000):
            ids = rng.integers(0, 1 << width, n).astype(np.uint32)
            words = token_files.pack(ids, width)
            assert len(words) == -(-n // 64) * width
            assert (token_files.unpack(words, width, n) == ids).all()


def test_shard_file_has_random_access(tmp_path):
    rng = np.random.default_rng(2)
    counts = np.array([0, 5, 300, 1, 0, 700, 64])
    ids = rng.integers(0, 50257, counts.sum()).astype(np.uint32)
    path = str(tmp_path / "x.tok")
    with pa.OSFile(path, "wb") as sink:
        writer = token_files.ShardWriter(sink, 16, block_ids=128)
        keys = np.arange(7)
        writer.add(keys[:3], keys[:3] == 0, counts[:3], ids[:305])
        writer.add(keys[3:], keys[3:] < 0, counts[3:], ids[305:])
        writer.close()
    with pa.OSFile(path) as source:
        reader = token_files.ShardReader(source)
        ends = np.cumsum(counts)
        for i in (5, 0, 2, 6, 1):
            assert (reader.document(i) == ids[ends[i] - counts[i] : ends[i]]).all()
        assert (reader.ids(100, 900) == ids[100:900]).all() and reader.nulls.tolist() == [True] + [False] * 6


def test_paths_of_object_stores(spark):
    from pyarrow import fs

    own = {
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.access.key": "all",
        "spark.hadoop.fs.s3a.secret.key": "s1",
        "fs.s3a.bucket.mine.access.key": "one",
    }
    assert token_files.store_settings(spark, "/shared/files") == {} == token_files.store_settings(spark, "hdfs://h/files")
    assert token_files.store_settings(spark, "s3a://other/files") == {}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        other = token_files.store_settings(spark, "s3a://other/files")
        assert other == {
            "access_key": "all", "secret_key": "s1", "endpoint_override": "store:9000", "scheme": "http", "region": "us-east-1"
        }
        assert token_files.store_settings(spark, "s3a://mine/files") == other | {"access_key": "one"}
        spark.conf.set("spark.hadoop.fs.s3a.endpoint", "store:9000")
        assert "scheme" not in token_files.store_settings(spark, "s3n://other/files")
        spark.conf.set("spark.hadoop.fs.s3a.connection.ssl.enabled", "false")
        assert token_files.store_settings(spark, "s3://other/files") == other
        system, folder = token_files.open_store("s3a://mine/some/files/", other)
        assert isinstance(system, fs.S3FileSystem) and folder == "mine/some/files"
    finally:
        for key in [*own, "spark.hadoop.fs.s3a.connection.ssl.enabled"]:
            spark.conf.unset(key)
    system, folder = token_files.open_store("file:///shared/files", {})
    assert isinstance(system, fs.LocalFileSystem) and folder == "/shared/files"


def test_token_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 20_000)
    docs = documents(spark, clashing=True).repartition(3)
    tokenizer = Tokenizer.from_file(JSON)
    folder = token_files.write_documents(docs, JSON, 50_257, 2, str(tmp_path / "files"))
    got = sorted(token_files.read(spark, folder).collect(), key=lambda r: r["start"])
    assert len({f.name for f in (tmp_path / "files").glob("*.tok")}) > 2
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert keys == sorted(keys) and len(got) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    at = 0
    for row in got:
        ids = np.array(tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids + [2], "<u4")
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    empty = token_files.write_documents(empty_documents(spark), JSON, 50_257, 2, str(tmp_path / "none"))
    assert token_files.read(spark, empty).count() == 0


