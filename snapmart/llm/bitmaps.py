"""Bitmaps of hashes, which DataFrame functions alone can build and look into.

A bitmap is a constant of the plan or, where the corpus decides how many hashes there are,
a broadcast table of chunks: the driver keeps the text of every plan, with each constant
in it several times. It is as large as its hashes ask for, up to a fixed size; beyond that
it lets more through, never less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm.text import fresh, long_table

# Bits of a bitmap for each hash, and at most and at least in all.
BITS_PER_HASH = 32
MAX_BITS, MIN_BITS = 1 << 25, 1 << 16
_WORD = 64
# Words in a row of a bitmap as a table, as a power of two.
_CHUNK = 8


def _slots(code: Column, bits: int) -> list[Column]:
    """Two places in a bitmap for one hash."""
    last = F.lit(bits - 1).cast("bigint")
    return [code.bitwiseAND(last), F.shiftrightunsigned(code, 32).bitwiseAND(last)]


def _words(hashes: DataFrame) -> tuple[DataFrame, int]:
    """(word, bits) of a bitmap with both places of every hash set, words of zeros left out,
    and its length in bits."""
    wanted = hashes.count() * BITS_PER_HASH
    bits = min(max(1 << max(wanted - 1, 1).bit_length(), MIN_BITS), MAX_BITS)
    slots = hashes.select(F.explode(F.array(*_slots(F.col("hash"), bits))).alias("slot"))
    return slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(slot & {_WORD - 1} as int))")).alias("bits")), bits


def bitmap_of(hashes: DataFrame) -> tuple[Column, int]:
    """A bitmap with both places of every hash set, as a constant, and its length in bits."""
    by_word, bits = _words(hashes)
    values = [0] * (bits // _WORD)
    for row in by_word.collect():  # one row per word of the bitmap at most
        values[row["word"]] = row["bits"]
    return long_table(values), bits


def bitmap_table(hashes: DataFrame) -> tuple[DataFrame, int]:
    """The same bitmap as a table (chunk, words), chunks of zeros left out, and its length in bits."""
    by_word, bits = _words(hashes)
    last = F.lit((1 << _CHUNK) - 1).cast("bigint")
    chunks = by_word.groupBy(F.shiftright("word", _CHUNK).alias("chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("word").bitwiseAND(last), "bits"))).alias("known"))
    return chunks.select("chunk", F.transform(
        F.sequence(F.lit(0).cast("bigint"), last),
        lambda i: F.coalesce(F.element_at("known", i), F.lit(0).cast("bigint"))).alias("words")), bits


def in_bitmap_table(df: DataFrame, bitmap: tuple[DataFrame, int], code: str) -> DataFrame:
    """The rows of ``df`` whose ``code`` is in the bitmap, and few others."""
    chunks, bits = bitmap
    chunk, held = fresh(df, "_chunk", "_words")
    # 2048 rows of 2 KB at most, whatever the number of hashes.
    chunks = F.broadcast(chunks.toDF(chunk, held))
    for slot in _slots(F.col(code), bits):
        word = F.shiftright(slot, 6).bitwiseAND(F.lit((1 << _CHUNK) - 1).cast("bigint")).cast("int")
        there = F.getbit(F.get(held, word), slot.bitwiseAND(F.lit(_WORD - 1).cast("bigint")).cast("int")) == 1
        df = df.join(chunks, (F.shiftright(slot, 6 + _CHUNK) == F.col(chunk)) & there, "left_semi")
    return df


def in_bitmap(bitmap: tuple[Column, int], code: Column) -> Column:
    values, bits = bitmap
    first, second = [
        F.getbit(F.get(values, F.shiftright(slot, 6)),
                 slot.bitwiseAND(F.lit(_WORD - 1).cast("bigint")).cast("int")) == 1
        for slot in _slots(code, bits)]
    return first & second
