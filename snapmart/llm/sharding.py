"""Placement of rows on shards by a permutation-filled lookup table.

The table has a prime number of slots. Every shard has an order of preference over all
slots (an offset and a step drawn from its name); shards take turns claiming the next
free slot of their order until the table is full, so each has the same number of slots,
give or take one, and few slots change hands when a shard joins or leaves. A row's key is
hashed to a slot. The table has a fixed size and goes along with the plan, so placing a
row takes one look-up and no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from snapmart.llm.text import fresh, long_table
from snapmart.session import scratch_path

SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(48))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _draw(name: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, salt=bytes([seed])).digest(), "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Number of the shard (its place in ``shards``) for every slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("name one shard or more, each once")
    if not _is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots must be prime and not below the number of shards")
    # The order of turns follows the names, so it does not depend on how they are listed.
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    at = [_draw(name, 1) % slots for name in shards]
    step = [_draw(name, 2) % (slots - 1) + 1 for name in shards]
    table, free = [-1] * slots, slots
    while True:
        for i in turns:
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key; NULL has one as well."""
    return F.pmod(F.xxhash64(key), F.lit(slots))


def place(df: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS,
          slot: str = "slot", shard: str = "shard") -> DataFrame:
    """Add the slot and the number of the shard of every row; other columns stay. Columns
    of these names are replaced. Equal keys go to the same shard."""
    table = long_table(lookup_table(shards, slots))
    return df.withColumn(slot, slot_of(F.col(key), slots)).withColumn(
        shard, F.get(table, F.col(slot)).cast("int"))


def write_shards(df: DataFrame, key: str, folder: str, shards: Sequence[str] = SHARDS,
                 slots: int = SLOTS) -> None:
    """Write rows to one folder per shard. Rows are gathered by shard, and adaptive execution
    splits a shard that is too large for one task, as where one key has most of the rows."""
    slot, shard = fresh(df, "slot", "shard")
    placed = place(df, key, shards, slots, slot, shard)
    placed.hint("rebalance", shard).write.partitionBy(shard).parquet(folder)


def sharded(df: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Write the rows of ``df`` to shards in the shared scratch area and return them as read
    from there, with their slot and shard. The files stay for whoever reads the shards."""
    folder = scratch_path(df.sparkSession, "shards")
    write_shards(df, key, folder, shards, slots)
    slot, shard = fresh(df, "slot", "shard")
    schema = StructType([*df.schema, StructField(slot, LongType()), StructField(shard, IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(folder)
