"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a prime-sized table (a
start and a stride from its name's hash). The shards take turns; at its turn
a shard claims the first free slot of its permutation (a shard of weight w
claims w slots a turn). So the slots divide evenly, and when a shard is added
or lost few slots change hands. The table is broadcast: a row's place is one
hash and one lookup, without a shuffle.

The table has ``size`` rows whatever the data (65,537 by default, and at most
MAX_SIZE): that bounds the broadcast. The key of a row is hashed alone, so a
frequent key stays on one shard as it must; rows without a key are spread by
``spare``.

Defined results: a null key is placed by the hash of ``spare`` (null: the
empty string); equal keys share a shard; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 65_537
MAX_SIZE = 1 << 22
SHARDS = 512


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill(shards: Sequence[str], size: int = SIZE, weights: Mapping[str, int] | None = None
         ) -> list[int]:
    """The shard number of each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need different names, one at least")
    if not _is_prime(size) or not len(shards) <= size <= MAX_SIZE:
        raise ValueError(f"the table size must be a prime from {len(shards)} to {MAX_SIZE}")
    at = [_number(s, "start") % size for s in shards]
    stride = [_number(s, "stride") % (size - 1) + 1 for s in shards]
    turns = [(weights or {}).get(s, 1) for s in shards]
    if not any(t > 0 for t in turns):
        raise ValueError("one shard at least needs a positive weight")
    slots, free = [-1] * size, size
    while True:
        for k, claims in enumerate(turns):
            for _ in range(claims):
                while slots[at[k]] >= 0:
                    at[k] = (at[k] + stride[k]) % size
                slots[at[k]] = k
                free -= 1
                if not free:
                    return slots


def lookup_table(spark: SparkSession, slots: Sequence[int]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(slots)), "slot bigint, shard int")


def slot_of(key: Column, size: int, spare: Column | None = None) -> Column:
    """The first 60 bits of the key's MD5, modulo the table size."""
    text = F.coalesce(key.cast("string"), F.md5(F.coalesce(
        (spare if spare is not None else F.lit("")).cast("string"), F.lit(""))))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint") % size


def assign(docs: DataFrame, slots: Sequence[int], key: str = "doc_id",
           spare: str | None = None) -> DataFrame:
    """(row, slot, shard): each input row and its place."""
    size = len(slots)
    if size > MAX_SIZE:
        raise ValueError("the lookup table is too large to broadcast")
    placed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        slot_of(F.col(f"`{key}`"), size, F.col(f"`{spare}`") if spare else None).alias("slot"))
    return placed.join(F.broadcast(lookup_table(docs.sparkSession, slots)), "slot") \
        .select("row", "slot", "shard")


def names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def write_shards(docs: DataFrame, path: str, slots: Sequence[int], key: str = "doc_id",
                 spare: str | None = None, rows_per_file: int = 1_000_000) -> None:
    """The documents as Parquet, one folder per shard. Each task writes its
    own file in a shard's folder, so a shard that a frequent key fills is
    written by many tasks."""
    assign(docs, slots, key, spare).select("shard", "row").write \
        .option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
