"""Blocked Bloom filters over 64-bit hashes, gathered by Spark and sent to every task.

A filter is an array of 64-bit blocks; a key sets a few bits of one block, so one look at
memory answers a probe. Keys come in shards with a filter each. All filters of a set
together have at most ``max_bits`` bits, so what is broadcast is bounded whatever the
input; with more keys than that is made for, probes let more through, never less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BITS_PER_KEY = 20
MAX_BITS = 1 << 27
BITS_SET = 5
# Blocks that are gathered into one row for the driver.
_CHUNK = 1 << 12


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Hashes whose every bit depends on all bits of those given."""
    out = hashes ^ (hashes >> np.uint64(33))
    out = out * np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out = out * np.uint64(0xC4CEB9FE1A85EC53)
    return out ^ (out >> np.uint64(33))


def _places(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of every mixed key, and the bits it sets there."""
    block = ((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = np.zeros(len(keys), dtype=np.uint64)
    for i in range(BITS_SET):
        bits |= np.uint64(1) << ((keys >> np.uint64(6 * i)) & np.uint64(63))
    return block.astype(np.int64), bits


def passes(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each of ``hashes`` may be among the keys of the filter."""
    if not len(hashes):
        return np.zeros(0, dtype=bool)
    block, bits = _places(mixed(hashes), len(filter_))
    return (filter_[block] & bits) == bits


def block_counts(keys: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Blocks of each shard's filter, from its number of keys."""
    wanted = sum(keys.values()) * BITS_PER_KEY
    share = min(1.0, max_bits / wanted) if wanted else 1.0
    return {shard: max(1, int(n * BITS_PER_KEY * share) // 64) for shard, n in keys.items()}


def build(keys: DataFrame, blocks: dict[int, int]) -> dict[int, np.ndarray]:
    """The filter of every shard, from rows of (shard int, hash bigint).

    Bits are put together where the blocks are; the driver gets one row for 4,096 blocks.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = batch.column(0).to_numpy(zero_copy_only=False)
            hashes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            counts = np.array([blocks[s] for s in np.unique(shards)], dtype=np.int64)
            block = np.zeros(len(shards), dtype=np.int64)
            bits = np.zeros(len(shards), dtype=np.uint64)
            for shard, n in zip(np.unique(shards), counts):
                own = shards == shard
                block[own], bits[own] = _places(mixed(hashes[own]), int(n))
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(shards, pa.int32()), "chunk": pa.array(block // _CHUNK, pa.int64()),
                "block": pa.array(block, pa.int64()), "bits": pa.array(bits.view(np.int64), pa.int64())})

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        words = np.zeros(_CHUNK, dtype=np.int64)
        words[rows["block"].to_numpy() % _CHUNK] = rows["bits"].to_numpy()
        return pd.DataFrame({"shard": [rows["shard"].iat[0]], "chunk": [rows["chunk"].iat[0]], "words": [words.tobytes()]})

    set_bits = keys.select(F.col("shard").cast("int"), "hash").mapInArrow(
        place, "shard int, chunk bigint, block bigint, bits bigint"
    ).groupBy("shard", "chunk", "block").agg(F.bit_or("bits").alias("bits"))
    out = {shard: np.zeros(n, dtype=np.uint64) for shard, n in blocks.items()}
    rows = set_bits.groupBy("shard", "chunk").applyInPandas(gather, "shard int, chunk bigint, words binary")
    for row in rows.collect():  # at most max_bits / 262,144 rows and one per shard
        own = out[row["shard"]]
        start = row["chunk"] * _CHUNK
        own[start:start + _CHUNK] = np.frombuffer(row["words"], np.uint64)[:len(own) - start]
    return out
