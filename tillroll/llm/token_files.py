"""Token ids in files of fixed-width bits, in order of the document ids, with random access.

A shard file holds the ids of a run of documents, each followed by an end id, in the fewest bits that the
vocabulary needs. Sixty-four ids of `width` bits fill `width` 64-bit words, so packing and unpacking are one
shift per place for whole columns of ids. Ids are packed in blocks; the footer has the byte offset of every
block, and the documents' ids and first positions, so any range of ids is read from its blocks alone. A
manifest lists the shards that were written in order; files of task attempts that were lost are not in it.

    header   magic, version, bits per id, ids per block             4 x uint32
    blocks   packed ids, each padded to 64 ids                      uint64 words
    footer   block offsets, first position of each document and the end, document ids, null marks
    trailer  offset of the footer, documents, ids, blocks, magic    5 x uint64

Files are opened by Arrow's file systems. Paths of `s3a:`, `s3n:` and `s3:` take the keys, endpoint and region that
the session has for `fs.s3a.`, those of a single bucket first; without keys the machine's own are used. All other
schemes are Arrow's own: `hdfs:` wants libhdfs on the executors.

Null texts are empty ones: they have the end id alone. Null document ids come first; rows of equal id keep
the order in which they are stored. An empty table gives a manifest without shards.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.bpe import ColumnEncoder
from tillroll.llm.common import text_pieces
from tillroll.session import scratch_path

MAGIC, VERSION = 0x534B4F54, 1
S3_SCHEMES = ("s3a", "s3n", "s3")
# Arrow's name of a setting, and the session's under fs.s3a.
S3_SETTINGS = {
    "access_key": "access.key",
    "secret_key": "secret.key",
    "session_token": "session.token",
    "endpoint_override": "endpoint",
    "region": "endpoint.region",
}
BLOCK_IDS = 65_536
# Text of a shard, which is one task's work.
SHARD_BYTES = 32_000_000


def store_settings(spark: SparkSession, path: str) -> dict[str, str]:
    """What Arrow needs to open `path`; nothing for schemes that name all they need themselves."""
    scheme, _, rest = path.partition("://")
    if scheme not in S3_SCHEMES:
        return {}
    bucket = rest.partition("/")[0]

    def setting(name: str) -> str | None:
        keys = (f"{start}fs.s3a.{own}{name}" for own in (f"bucket.{bucket}.", "") for start in ("", "spark.hadoop."))
        return next((value for key in keys if (value := spark.conf.get(key, None))), None)

    found = {own: value for own, name in S3_SETTINGS.items() if (value := setting(name))}
    endpoint = found.get("endpoint_override", "")
    if "://" in endpoint:
        found["scheme"], found["endpoint_override"] = endpoint.split("://", 1)
    elif setting("connection.ssl.enabled") == "false":
        found["scheme"] = "http"
    if "endpoint_override" in found:  # a store of one's own has no regions to be looked up
        found.setdefault("region", "us-east-1")
    return found


def open_store(path: str, settings: dict[str, str]) -> tuple[fs.FileSystem, str]:
    """The file system of `path`, and the path inside it."""
    scheme, _, rest = path.partition("://")
    if scheme in S3_SCHEMES:
        return fs.S3FileSystem(**settings), rest.rstrip("/")
    return fs.FileSystem.from_uri(path)


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> np.ndarray:
    """64-bit words of the ids, the last 64 filled up with zeros."""
    rows = -(-len(ids) // 64)
    padded = np.zeros(rows * 64, np.uint64)
    padded[: len(ids)] = ids
    columns = padded.reshape(rows, 64)
    words = np.zeros((rows, width), np.uint64)
    for place in range(64):
        word, shift = divmod(place * width, 64)
        words[:, word] |= columns[:, place] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= columns[:, place] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack(words: np.ndarray, width: int, count: int) -> np.ndarray:
    rows = -(-count // 64)
    words = words[: rows * width].reshape(rows, width)
    columns = np.empty((rows, 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for place in range(64):
        word, shift = divmod(place * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        columns[:, place] = value & mask
    return columns.reshape(-1)[:count].astype(np.uint32)


class ShardWriter:
    def __init__(self, sink, width: int, block_ids: int = BLOCK_IDS):
        self.sink, self.width, self.block_ids = sink, width, block_ids
        self.sink.write(np.array([MAGIC, VERSION, width, block_ids], "<u4").tobytes())
        self.offset = 16
        self.blocks: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.keys: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []

    def add(self, keys: np.ndarray, nulls: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.keys.append(keys)
        self.nulls.append(nulls)
        self.starts.append(self.n_ids + np.cumsum(counts) - counts)
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block_ids:
            self._flush(self.n_waiting // self.block_ids * self.block_ids)

    def _flush(self, count: int) -> None:
        every = np.concatenate(self.waiting)
        for low in range(0, count, self.block_ids):
            data = pack(every[low : min(count, low + self.block_ids)], self.width).astype("<u8").tobytes()
            self.blocks.append(self.offset)
            self.sink.write(data)
            self.offset += len(data)
        self.waiting, self.n_waiting = [every[count:]], len(every) - count

    def close(self) -> None:
        if self.n_waiting:
            self._flush(self.n_waiting)
        starts = np.append(np.concatenate(self.starts), self.n_ids)
        footer = [np.array(self.blocks, "<u8"), starts.astype("<u8"), np.concatenate(self.keys).astype("<i8")]
        for part in footer:
            self.sink.write(part.tobytes())
        self.sink.write(np.concatenate(self.nulls).astype(np.uint8).tobytes())
        trailer = [self.offset, len(starts) - 1, self.n_ids, len(self.blocks), MAGIC]
        self.sink.write(np.array(trailer, "<u8").tobytes())


class ShardReader:
    """Random access to one shard file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        footer, n_docs, n_ids, n_blocks, magic = np.frombuffer(source.read_at(40, size - 40), "<u8").tolist()
        head = np.frombuffer(source.read_at(16, 0), "<u4").tolist()
        if magic != MAGIC or head[:2] != [MAGIC, VERSION]:
            raise ValueError("not a shard file")
        self.width, self.block_ids = head[2:]
        self.n_docs, self.n_ids = n_docs, n_ids
        index = source.read_at(size - 40 - footer, footer)
        self.blocks = np.frombuffer(index, "<u8", n_blocks)
        self.starts = np.frombuffer(index, "<u8", n_docs + 1, 8 * n_blocks).astype(np.int64)
        self.keys = np.frombuffer(index, "<i8", n_docs, 8 * (n_blocks + n_docs + 1))
        self.nulls = np.frombuffer(index, np.uint8, n_docs, 8 * (n_blocks + 2 * n_docs + 1)).astype(bool)
        self.cached: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint32))

    def block(self, number: int) -> np.ndarray:
        if self.cached[0] != number:
            count = min(self.block_ids, self.n_ids - number * self.block_ids)
            data = self.source.read_at(-(-count // 64) * self.width * 8, int(self.blocks[number]))
            self.cached = (number, unpack(np.frombuffer(data, "<u8"), self.width, count))
        return self.cached[1]

    def ids(self, low: int, high: int) -> np.ndarray:
        parts = []
        for number in range(low // self.block_ids, -(-high // self.block_ids)):
            base = number * self.block_ids
            parts.append(self.block(number)[max(0, low - base) : high - base])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))


@functools.cache
def _library_encoder(tokenizer_path: str) -> ColumnEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def encode(pieces: list[bytes]) -> list[list[int]]:
        found = tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [e.ids for e in found]

    return ColumnEncoder(encode)


def write(
    df: DataFrame, tokenizer_path: str, end_id: int, width: int, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokenize all texts and write them to shard files under `path`; returns the manifest.

    The texts are dealt to the tasks by ranges of (id, place in the input), so that also one id with most
    rows is spread, and become tokens where they are written: only texts are shuffled, and nothing else is
    stored.
    """
    numbered = df.select(
        F.col(id_col).cast("long").alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text")
    )
    settings = store_settings(df.sparkSession, path)
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))

    def run(batches):
        encoder = _library_encoder(tokenizer_path)
        writer = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, rows, texts = batch.columns
            if writer is None:
                system, folder = open_store(path, settings)
                system.create_dir(folder, recursive=True)
                name = f"shard-{uuid.uuid4().hex}.tok"
                sink = system.open_output_stream(f"{folder}/{name}")
                writer = ShardWriter(sink, width)
                first = (keys[0].as_py(), rows[0].as_py())
            nulls = keys.is_null().to_numpy(zero_copy_only=False)
            known = keys.fill_null(0).to_numpy(zero_copy_only=False)
            for low, piece in text_pieces(texts):
                ids, counts = encoder.encode(piece)
                own = slice(low, low + len(piece))
                writer.add(known[own], nulls[own], counts + 1, np.insert(ids, np.cumsum(counts), end_id))
        if writer is not None:
            writer.close()
            sink.close()
            docs = sum(map(len, writer.keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([first[0]], pa.int64()), pa.array([first[1]], pa.int64()),
                 pa.array([docs], pa.int64()), pa.array([writer.n_ids], pa.int64())],
                ["file", "first_key", "first_row", "n_docs", "n_ids"],
            )

    dealt = numbered.repartitionByRange(shards, F.col("key").asc_nulls_first(), "row")
    ordered = dealt.sortWithinPartitions(F.col("key").asc_nulls_first(), "row")
    listed = ordered.mapInArrow(run, "file string, first_key long, first_row long, n_docs long, n_ids long")
    manifest = f"{path.rstrip('/')}/manifest"
    listed.write.parquet(manifest)
    return df.sparkSession.read.schema(listed.schema).parquet(manifest)


def _documents(reader: ShardReader) -> Iterator[tuple[int, np.ndarray]]:
    for number in range(reader.n_docs):
        yield number, reader.document(number)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    settings = store_settings(spark, path)
    manifest = spark.read.parquet(f"{path.rstrip('/')}/manifest")
    # One row per file of 32 MB of text, in order of the documents: some three million rows for 100 TB.
    before = Window.orderBy(F.col("first_key").asc_nulls_first(), "first_row").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def run(batches):
        for batch in batches:
            for file, base in zip(batch["file"].to_pylist(), batch["base"].to_pylist()):
                system, folder = open_store(path, settings)
                with system.open_input_file(f"{folder}/{file}") as source:
                    reader = ShardReader(source)
                    crcs = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in _documents(reader)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.keys, mask=reader.nulls), pa.array(base + reader.starts[:-1]),
                         pa.array(np.diff(reader.starts)), pa.array(crcs, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    files = max(1, manifest.count())
    return listed.repartition(files).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_documents(
    df: DataFrame, tokenizer_path: str, vocabulary: int, end_id: int, path: str | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> str:
    """Tokenize and write a whole table; returns the folder."""
    path = path or scratch_path(df.sparkSession, "token-files")
    write(df, tokenizer_path, end_id, bits_for(max(vocabulary, end_id + 1)), path, id_col, text_col)
    return path
