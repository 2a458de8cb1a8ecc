"""A Bloom filter as a small relation, so that Catalyst can broadcast it whatever the number of keys.

The filter is cut into blocks of 64 bits. A key's hash names one block and sets a few bits in it, so the filter
is a table (block, bits) that one aggregation with map-side combine makes, and a test is one hash join with a
broadcast of at most MAX_BLOCKS rows (two longs each). The tested side is not shuffled.

No key that was put in is ever denied. Null keys are never put in and always denied. Beyond
MAX_BLOCKS * KEYS_PER_BLOCK keys the filter grows no further and lets more strangers pass, never fewer members.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most a million blocks, 16 MB of longs, are broadcast. With six keys to a block about one stranger in
# twenty-five passes.
MAX_BLOCKS = 1 << 20
KEYS_PER_BLOCK = 6
# Where in the hash the bit numbers lie; the block number is taken from the bits below.
BIT_PLACES = (24, 30, 36, 42)


def _block(key: Column, blocks: int) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(blocks - 1))


def _bits(key: Column) -> Column:
    bits = F.lit(0).cast("long")
    for place in BIT_PLACES:
        number = F.shiftrightunsigned(F.xxhash64(key), place).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), number))
    return bits


@dataclass
class BloomFilter:
    """`table` holds (__block, __bits); `blocks` is a power of two."""

    table: DataFrame
    blocks: int


def blocks_for(n_keys: int, max_blocks: int = MAX_BLOCKS) -> int:
    return min(max_blocks, 1 << max(0, (n_keys // KEYS_PER_BLOCK).bit_length()))


def bloom_filter(df: DataFrame, key: Column, n_keys: int, max_blocks: int = MAX_BLOCKS) -> BloomFilter:
    """Filter over the keys of `df`, sized for about `n_keys` of them."""
    blocks = blocks_for(n_keys, max_blocks)
    own = df.select(key.alias("__key")).where("__key is not null")
    hashed = own.select(_block(F.col("__key"), blocks).alias("__block"), _bits(F.col("__key")).alias("__own"))
    return BloomFilter(hashed.groupBy("__block").agg(F.bit_or("__own").alias("__bits")), blocks)


def mark_maybe(df: DataFrame, key: Column, bloom: BloomFilter, name: str) -> DataFrame:
    """`df` with a boolean column `name`: false where the key is surely not in the filter."""
    probed = df.withColumns({"__block": _block(key, bloom.blocks), "__own": _bits(key)})
    probed = probed.withColumn("__own", F.when(key.isNotNull(), F.col("__own")))
    joined = probed.join(F.broadcast(bloom.table), "__block", "left")
    held = F.col("__bits").bitwiseAND(F.col("__own")) == F.col("__own")
    return joined.withColumn(name, F.coalesce(held, F.lit(False))).drop("__block", "__own", "__bits")
