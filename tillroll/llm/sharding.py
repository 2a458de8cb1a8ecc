"""Placing rows on shards by a permutation-filled lookup table.

Every shard ranks all slots of a table of prime size by a permutation of its own (a start and a stride).
The shards take turns, each claiming the first slot on its list that is still free, until the table is
full: shares differ by one slot at most, and when a shard is added or removed few other rows move. A row's
slot is a hash of its key, and its shard the one at that slot: one broadcast lookup of constant size.

The table depends on the shard names and its size alone, never on the data. A null key is hashed as a value
of its own, so such rows stay together; equal keys, repeated rows and empty strings are placed alike.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A prime well over a hundred times the number of shards keeps the shares even when shards change.
TABLE_SIZE = 65_537


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Index of the shard that claimed each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("name every shard once")
    if size <= len(shards) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime above the number of shards")
    at = [_number(f"start {name}") % size for name in shards]
    stride = [_number(f"stride {name}") % (size - 1) + 1 for name in shards]
    owner = [-1] * size
    for turn in range(size):
        shard = turn % len(shards)
        while owner[at[shard]] >= 0:
            at[shard] = (at[shard] + stride[shard]) % size
        owner[at[shard]] = shard
    return owner


def lookup_table(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """(slot, shard) for every slot; `size` rows, whatever the data."""
    names = F.array(*[F.lit(s) for s in shards])
    owners = F.split(F.lit(",".join(map(str, fill_table(shards, size)))), ",")
    return (
        spark.range(1)
        .select(F.posexplode(owners).alias("slot", "owner"))
        .select(F.col("slot").cast("long"), F.element_at(names, F.col("owner").cast("int") + 1).alias("shard"))
    )


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key, from the first 60 bits of its MD5; null has a slot of its own."""
    text = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size))


def assign(df: DataFrame, key: Column, shards: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """All rows and columns of `df` with `slot` and `shard` in place of any columns of those names.

    No row is moved: the lookup table is broadcast, and its bound is `size` rows.
    """
    table = lookup_table(df.sparkSession, shards, size)
    keyed = df.withColumn("__key_slot", slot_of(key, size)).drop("slot", "shard")
    return keyed.join(F.broadcast(table), F.col("__key_slot") == F.col("slot")).drop("__key_slot")
