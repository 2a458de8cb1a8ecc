"""Reading sample tables, storing intermediate tables, and walking Arrow text columns in bounded pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillroll.session import SHUFFLE_CLEANUP, scratch_path, setting

# Words are maximal runs of characters other than ASCII white space, in every operator here.
ASCII_SPACE = " \t\n\x0b\x0c\r"

# Python steps work on about this much text at a time; one longer text is a piece of its own.
PIECE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df`, written once to the shared scratch folder and read back: a cut in the lineage
    that survives the loss of executors. The shuffle files that it took go when it is written, not when the driver
    happens to collect its garbage, so steps that are stored do not pile up on the executors' disks."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def schema_with(df: DataFrame, keep: list[str], more: str) -> StructType:
    """Schema of the columns `keep`, then the fields written in `more`."""
    return StructType(df.select(*keep).schema.fields + StructType.fromDDL(more).fields)


def text_pieces(texts: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) over a column, cut between rows so that a piece holds about `piece_bytes`.

    Null texts come out as empty ones.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.type != pa.string():
        texts = texts.cast(pa.string())
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + piece_bytes, side="right")))
        yield first, texts.slice(first, last - first)
        first = last


def freed_pieces(texts: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """As `text_pieces`; afterwards memory that Arrow holds unused goes back to the system."""
    yield from text_pieces(texts, piece_bytes)
    pa.default_memory_pool().release_unused()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and the number of words in each text."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False).astype(bool)
    if filled.all():
        return words, counts
    # White space at either end of a text leaves an empty word there.
    owner = np.repeat(np.arange(len(counts)), counts)[filled]
    return words.filter(pa.array(filled)), np.bincount(owner, minlength=len(counts))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + lengths[i] - 1 of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
