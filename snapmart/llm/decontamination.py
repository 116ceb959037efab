"""Benchmark decontamination by spaced seeds.

A seed is a mask over neighbouring tokens: tokens at its 1s are hashed together, those
at its 0s are ignored, so a substituted token there does not hide a passage. Every
place of every benchmark item and of every document is hashed under all masks, hashes
are joined, and each hit is verified by laying item and document over each other: the
longest stretch in which at most every ``tolerance``-th token differs must be long
enough.

Items too short for the masks are cut into one part more than tokens of them may differ,
so one part of every match is whole; parts are hashed and joined like masks.

Only DataFrame functions are used. Masks are made of pairs of neighbouring tokens: a
document's pairs are looked up in a bitmap of the benchmark's, a mask is only hashed where
all its pairs may be there, and looked up in a bitmap of masks. Bitmaps are as large as
the benchmark asks for, up to a fixed size; what passes is joined by exact hash.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm.bitmaps import bitmap_of, in_bitmap
from snapmart.llm.text import fresh
from snapmart.session import materialise

# Masks, given by where their pairs of 1s start: 11011011, 110011011, 1110111, 111111 and
# 111000000111. Together they hit every stretch of twelve tokens or more in which one of
# five differs, wherever the differing ones are.
SEEDS = ((0, 3, 6), (0, 4, 7), (0, 1, 4, 5), (0, 2, 4), (0, 1, 9, 10))
MIN_OVERLAP = 12
TOLERANCE = 5


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def token_hashes(text: Column) -> Column:
    return F.transform(tokens(text), lambda token: F.xxhash64(token))


def pair_hashes(hashes: Column) -> Column:
    """Hash of every two neighbouring tokens, from which the masks are put together."""
    return F.transform(
        F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda later, at: F.xxhash64(F.get(hashes, at), later))


def _places(count: Column) -> Column:
    """0, 1, ... for ``count`` places; none for a negative count."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _mask(pairs: Column, at: Column, number: int) -> Column:
    return F.xxhash64(*[F.get(pairs, at + offset) for offset in SEEDS[number]], F.lit(number))


def _part(hashes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.slice(hashes, at + 1, F.lit(size)), F.lit(len(SEEDS) + size))


def _hit(code: Column, at: Column) -> Column:
    return F.struct(code.alias("hash"), at.cast("int").alias("at"))


def parts_of(length: int, tolerance: int = TOLERANCE) -> list[tuple[int, int]]:
    """(start, size) of the parts of an item of ``length`` tokens: one more than tokens of it
    may differ, as equal in size as can be."""
    count = length // tolerance + 1
    edges = [i * length // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:]) if b > a]


def _item_hits(min_overlap: int, tolerance: int) -> Column:
    """All masks of an item, and the parts of one shorter than ``min_overlap``."""
    pairs, hashes = F.col("pairs"), F.col("hashes")

    def mask(number: int) -> Column:
        places = _places(F.size(pairs) - SEEDS[number][-1])
        return F.transform(places, lambda at: _hit(_mask(pairs, at, number), at))

    masks = map(mask, range(len(SEEDS)))
    parts = F.array().cast("array<struct<hash:bigint,at:int>>")
    for length in range(1, min_overlap):
        parts = F.when(F.size(hashes) == length, F.array(*[
            _hit(_part(hashes, F.lit(start), size), F.lit(start)) for start, size in parts_of(length, tolerance)
        ])).otherwise(parts)
    return F.concat(*masks, parts)


def overlaps(documents: DataFrame, benchmark: DataFrame, min_overlap: int = MIN_OVERLAP,
             tolerance: int = TOLERANCE) -> DataFrame:
    """Verified overlaps, one row per row of ``documents``, benchmark item and alignment:
    (row, doc_id, mark, item, item_id, doc_at, item_at, n_tokens, n_equal).

    ``row`` and ``item`` tell rows of equal or NULL id apart, ``mark`` is a hash of the
    text. ``doc_at`` and ``item_at`` count tokens from 0. A stretch counts if it starts and ends with equal tokens, has at
    least ``min_overlap`` tokens (or all of a shorter item's), and at most one of
    ``tolerance`` tokens differs. NULL and empty texts overlap with nothing.
    """
    items = materialise(
        benchmark.select(
            F.monotonically_increasing_id().alias("item"), "item_id", token_hashes(F.col("text")).alias("hashes"))
        .withColumn("pairs", pair_hashes(F.col("hashes"))).filter(F.size("hashes") > 0)
        .select("item", "item_id", "pairs", F.col("hashes").alias("item_hashes"),
                _item_hits(min_overlap, tolerance).alias("hits")), "items")
    seeds = items.select("item", F.explode("hits").alias("hit")).select(
        "item", F.col("hit.hash").alias("hash"), F.col("hit.at").alias("item_at"))
    pair_bitmap = bitmap_of(items.select(F.explode("pairs").alias("hash")).distinct())
    bitmap = bitmap_of(seeds.select("hash").distinct())
    # The sizes of parts that short items have; none without short items.
    lengths = items.select(F.size("item_hashes").alias("n")).filter(F.col("n") < min_overlap).distinct().collect()
    sizes = sorted({size for r in lengths for _, size in parts_of(r["n"], tolerance)})

    pairs, hashes = F.col("pairs"), F.col("doc_hashes")
    split = documents.select(
        "doc_id", F.xxhash64("text").alias("mark"), token_hashes(F.col("text")).alias("doc_hashes"))
    # Numbers keep the optimiser from moving filters below the steps they look at, where
    # these would be worked out once more. Either bitmap is looked into in one place only,
    # as every other would be a copy of it in the plan.
    looked_up = split.withColumn("pairs", pair_hashes(hashes)).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "mark", "doc_hashes", "pairs",
        F.transform(pairs, lambda code: in_bitmap(pair_bitmap, code)).alias("present"))
    likely = looked_up.select("*", F.filter(
        _places(F.size(pairs)), lambda at: F.get("present", at)).alias("likely"), F.monotonically_increasing_id().alias("_seen"))
    if not sizes:
        likely = likely.filter(F.size("likely") >= min(len(seed) for seed in SEEDS))

    def masks(number: int) -> Column:
        """Places where all pairs of a mask may be there, with its hash."""
        rest = SEEDS[number][1:]
        fits = F.filter("likely", lambda at: reduce(and_, [
            F.coalesce(F.get("present", at + o), F.lit(False)) for o in rest]))
        return F.transform(fits, lambda at: _hit(_mask(pairs, at, number), at))

    def windows(size: int) -> Column:
        return F.transform(_places(F.size(hashes) - (size - 1)), lambda at: _hit(_part(hashes, at, size), at))

    some = materialise(
        likely.select(
            "row", "doc_id", "mark", "doc_hashes", F.monotonically_increasing_id().alias("_kept"),
            F.filter(F.concat(*map(masks, range(len(SEEDS))), *map(windows, sizes)),
                     lambda hit: in_bitmap(bitmap, hit["hash"])).alias("hits"))
        .filter(F.size("hits") > 0).drop("_kept"), "candidates")
    hits = some.select("row", F.explode("hits").alias("hit")).select(
        "row", F.col("hit.hash").alias("hash"), F.col("hit.at").alias("doc_at"))
    aligned = (
        hits.join(seeds, "hash")
        .select("row", "item", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct()
    )
    laid = (
        aligned.join(some.select("row", "doc_id", "mark", "doc_hashes"), "row")
        .join(items.select("item", "item_id", "item_hashes"), "item")
    )
    return laid.select(
        "row", "doc_id", "mark", "item", "item_id", "shift", F.size("item_hashes").alias("length"),
        _stretch(F.col("doc_hashes"), F.col("item_hashes"), F.col("shift"), tolerance).alias("best"),
    ).filter(
        F.col("best.n_tokens") >= F.least(F.lit(min_overlap), "length")
    ).select(
        "row", "doc_id", "mark", "item", "item_id",
        (F.col("best.item_at") + F.col("shift")).cast("bigint").alias("doc_at"),
        F.col("best.item_at").cast("bigint").alias("item_at"),
        F.col("best.n_tokens").cast("bigint").alias("n_tokens"),
        F.col("best.n_equal").cast("bigint").alias("n_equal"))


def _stretch(doc: Column, item: Column, shift: Column, tolerance: int) -> Column:
    """Longest stretch of an alignment: (n_tokens, n_equal, item_at), the first on ties.

    Every stretch that starts and ends with equal tokens is given by two of the equal
    places; an item has few of them, as benchmark items are short.
    """
    equal = F.filter(
        F.sequence(F.lit(0), F.size(item) - 1),
        lambda i: F.coalesce(
            (i + shift >= 0) & (F.get(doc, F.greatest(i + shift, F.lit(0))) == F.get(item, i)), F.lit(False)))
    # equal[j] = the place of the j-th equal token: between two of them all tokens
    # but those counted differ.
    return F.aggregate(
        F.array(equal),
        F.struct(F.lit(0).alias("n_tokens"), F.lit(0).alias("n_equal"), F.lit(0).alias("item_at")),
        lambda start, places: F.aggregate(
            F.sequence(F.lit(0), F.size(places) - 1), start,
            lambda best, a: F.when(F.size(places) == 0, best).otherwise(F.aggregate(
                F.sequence(a, F.size(places) - 1), best,
                lambda inner, b: _longer(
                    inner, F.get(places, b) - F.get(places, a) + 1, b - a + 1,
                    F.get(places, a), tolerance)))))


def _longer(best: Column, length: Column, same: Column, at: Column, tolerance: int) -> Column:
    fits = (length - same) * tolerance <= length
    return F.when(
        fits & (length > best["n_tokens"]),
        F.struct(length.alias("n_tokens"), same.alias("n_equal"), at.alias("item_at")),
    ).otherwise(best)


def contaminated(documents: DataFrame, benchmark: DataFrame, min_overlap: int = MIN_OVERLAP,
                 tolerance: int = TOLERANCE) -> DataFrame:
    """The longest overlap of each document with each item: (doc_id, mark, item_id, doc_at,
    item_at, n_tokens, n_equal). Repeated rows of either table stay repeated."""
    found = overlaps(documents, benchmark, min_overlap, tolerance)
    best = found.groupBy("row", "doc_id", "mark", "item", "item_id").agg(F.max(F.struct(
        "n_tokens", "n_equal", (-F.col("doc_at")).alias("doc"), (-F.col("item_at")).alias("at"))).alias("best"))
    return best.select(
        "doc_id", "mark", "item_id", (-F.col("best.doc")).alias("doc_at"),
        (-F.col("best.at")).alias("item_at"), "best.n_tokens", "best.n_equal")


def keep_clean(documents: DataFrame, benchmark: DataFrame, min_overlap: int = MIN_OVERLAP,
               tolerance: int = TOLERANCE) -> DataFrame:
    """The documents that overlap with no benchmark item, with all their columns."""
    (mark,) = fresh(documents, "_mark")
    found = materialise(
        contaminated(documents.select("doc_id", "text"), benchmark, min_overlap, tolerance)
        .select(F.col("doc_id").alias("_found_id"), F.col("mark").alias("_found_mark")).distinct(), "found")
    rows = documents.withColumn(mark, F.xxhash64("text"))
    return rows.join(
        found, F.equal_null(rows["doc_id"], found["_found_id"]) & (rows[mark] == found["_found_mark"]),
        "left_anti").drop(mark)
