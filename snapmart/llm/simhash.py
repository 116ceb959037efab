"""Near duplicates by SimHash: fingerprints that differ in a few bits are linked.

The distinct fingerprints are joined with themselves by walking binary tries. A trie
is a sorted array: a node is a range of it, and its children are the parts with the
next bit 0 and 1. Pairs of nodes are walked together from the root, the differing
bits on the way are added up, and a pair is given up once there are more than the
budget allows.

To spread the walk over tasks, the 64 bits are cut into one block more than the
budget. Two fingerprints within the budget agree in one block at least, so for each
block the tries are rotated to begin with it, and every node pair (p, p) below that
block is a piece of work of its own. Pieces with many fingerprints are split further
into pairs of parts, and every pair of parts is walked by a task of its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from snapmart.llm.components import connected_components
from snapmart.llm.text import fresh
from snapmart.session import materialise

BITS = 64
BUDGET = 4
SHINGLE = 4
SEED = 42
# A piece of work holds this many fingerprints at most, or two parts of that size.
PART = 100_000
# Pairs of nodes looked at together, and pairs of leaves compared directly.
FRONTIER = 200_000
DIRECT = 16

_EVERY_EIGHTH = np.uint64(0x0101010101010101)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of ``hashes`` have each of the 64 bits set."""
    padded = np.zeros(-(-len(hashes) // 255) * 255, dtype=np.uint64)
    padded[: len(hashes)] = hashes
    counts = np.empty((8, 8), dtype=np.int64)
    for shift in range(8):
        # Every byte counts one bit, of up to 255 hashes.
        lanes = ((padded >> np.uint64(shift)) & _EVERY_EIGHTH).reshape(-1, 255)
        sums = lanes.sum(axis=1, dtype=np.uint64).astype("<u8")
        counts[:, shift] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.reshape(BITS)


def shingle_hashes(data: bytes | None, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words of a UTF-8 text, or of all words if there are
    fewer; none if it is NULL or has no word."""
    found = (data or b"").lower().split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(found) - size + 1, 1)
    spans = zip(starts[:last].tolist(), ends[min(size, len(found)) - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in spans), dtype=np.uint64, count=last)


def fingerprint_of_hashes(hashes: np.ndarray) -> int:
    """Fingerprint of the shingles with these hashes; 0 if there are none."""
    bits = 2 * _bit_counts(hashes) > len(hashes)
    return sum(1 << int(i) for i in np.flatnonzero(bits))


def fingerprint(data: bytes | None) -> int:
    """Fingerprint of a UTF-8 text; 0 if it is NULL or has no word."""
    return fingerprint_of_hashes(shingle_hashes(data, SHINGLE))


@F.pandas_udf(LongType())
def _fingerprints(data: pd.Series) -> pd.Series:
    values = np.fromiter(map(fingerprint, data), dtype=np.uint64, count=len(data))
    return pd.Series(values.view(np.int64))


def fingerprint_of(text: Column) -> Column:
    """Fingerprint as a long with the same 64 bits."""
    return _fingerprints(text.cast("binary"))


class _Forest:
    """Which members of one array have been linked; roots are the smallest members."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.root[a], self.root[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = self.root[self.root]
                if np.array_equal(above, self.root):
                    break
                self.root = above

    def settled(self, a_lo, a_hi, b_lo, b_hi) -> np.ndarray:
        """Pairs of ranges whose members are all linked with each other already."""
        changes = np.concatenate(([0], np.cumsum(self.root[1:] != self.root[:-1])))
        return (
            (changes[a_hi - 1] == changes[a_lo]) & (changes[b_hi - 1] == changes[b_lo])
            & (self.root[a_lo] == self.root[b_lo]))


def _group_bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return starts, np.concatenate((starts[1:], [len(keys)]))


def _compare(values, a_lo, a_hi, b_lo, b_hi, budget, forest) -> None:
    """Link all close members of small ranges."""
    width = b_hi - b_lo
    sizes = (a_hi - a_lo) * width
    pair = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    a, b = a_lo[pair] + at // width[pair], b_lo[pair] + at % width[pair]
    close = np.bitwise_count(values[a] ^ values[b]) <= budget
    forest.link(a[close], b[close])


def _walk(values: np.ndarray, pairs: tuple, depth: int, budget: int, forest: _Forest) -> None:
    """Walk pairs of trie nodes (ranges of the sorted ``values``) down to the leaves."""
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, pairs)]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs[0]) > FRONTIER:
            stack += [(depth, tuple(x[k:k + FRONTIER] for x in pairs))
                      for k in range(0, len(pairs[0]), FRONTIER)]
            continue
        a_lo, a_hi, b_lo, b_hi, diff = pairs
        same = a_lo == b_lo
        open_ = ~forest.settled(a_lo, a_hi, b_lo, b_hi) & ~(same & (a_hi - a_lo == 1))
        small = (a_hi - a_lo) * (b_hi - b_lo) <= DIRECT
        now = open_ & small
        if now.any():
            _compare(values, a_lo[now], a_hi[now], b_lo[now], b_hi[now], budget, forest)
        a_lo, a_hi, b_lo, b_hi, diff, same = (
            x[open_ & ~small] for x in (a_lo, a_hi, b_lo, b_hi, diff, same))
        if not len(a_lo):
            continue
        if depth == BITS:
            # Equal values on either side: all members of both ranges are within diff.
            for x, y, z, w in zip(a_lo, a_hi, b_lo, b_hi):
                members = np.concatenate((np.arange(x, y), np.arange(z, w)))
                forest.link(members[:-1], members[1:])
            continue
        if depth not in ones:
            bit = (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
        count = ones[depth]
        a_mid, b_mid = a_hi - (count[a_hi] - count[a_lo]), b_hi - (count[b_hi] - count[b_lo])
        cross = ~same  # of a node with itself, 1-0 repeats 0-1
        parts = [
            (a_lo, a_mid, b_lo, b_mid, diff),
            (a_mid, a_hi, b_mid, b_hi, diff),
            (a_lo, a_mid, b_mid, b_hi, diff + 1),
            tuple(x[cross] for x in (a_mid, a_hi, b_lo, b_mid, diff + 1)),
        ]
        merged = [np.concatenate(x) for x in zip(*parts)]
        alive = (merged[0] < merged[1]) & (merged[2] < merged[3]) & (merged[4] <= budget)
        if alive.any():
            stack.append((depth + 1, tuple(x[alive] for x in merged)))


def close_links(prints: np.ndarray, sides: np.ndarray | None, offset: int, width: int,
                budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between distinct fingerprints that agree in the
    ``width`` bits from bit ``offset`` (counted from the top).

    With ``sides``, only links between side 0 and side 1 are looked for.
    """
    turned = prints if offset == 0 else (
        (prints << np.uint64(offset)) | (prints >> np.uint64(BITS - offset)))
    order = np.argsort(turned) if sides is None else np.lexsort((turned, sides))
    values, original = turned[order], prints[order]
    forest = _Forest(len(values))
    keys = values >> np.uint64(BITS - width)
    if sides is None:
        lo, hi = _group_bounds(keys)
        pairs = (lo, hi, lo, hi, np.zeros(len(lo), dtype=np.int64))
    else:
        first = int((sides == 0).sum())
        if first in (0, len(values)):
            return original[:0], original[:0]
        a_lo, a_hi = _group_bounds(keys[:first])
        b_lo, b_hi = _group_bounds(keys[first:])
        _, at_a, at_b = np.intersect1d(keys[a_lo], keys[first + b_lo], return_indices=True)
        pairs = (a_lo[at_a], a_hi[at_a], first + b_lo[at_b], first + b_hi[at_b],
                 np.zeros(len(at_a), dtype=np.int64))
    _walk(values, pairs, width, budget, forest)
    linked = np.flatnonzero(forest.root != np.arange(len(values)))
    return original[linked], original[forest.root[linked]]


def _blocks(budget: int) -> list[tuple[int, int]]:
    """(offset, width) of budget + 1 blocks that make up the 64 bits."""
    edges = [round(i * BITS / (budget + 1)) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _links(budget: int):
    blocks = _blocks(budget)

    def links(piece: pd.DataFrame) -> pd.DataFrame:
        offset, width = blocks[int(piece["block"].iat[0])]
        one, other = int(piece["one"].iat[0]), int(piece["other"].iat[0])
        sides = None if one == other else (piece["part"].to_numpy() == other).astype(np.int8)
        a, b = close_links(piece["print"].to_numpy().view(np.uint64), sides, offset, width, budget)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return links


def near_links(prints: DataFrame, budget: int = BUDGET, part: int = PART) -> DataFrame:
    """Links (a, b) between distinct fingerprints of column ``print``, enough of them to
    join all that are connected by steps of at most ``budget`` differing bits."""
    blocks = F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(
            F.shiftleft("print", offset), BITS - width).alias("key"))
        for i, (offset, width) in enumerate(_blocks(budget))])
    keyed = prints.select("print", F.explode(blocks).alias("at")).select("print", "at.*")
    # One row per block and key: at most 40,960 of them for the usual budget.
    sizes = keyed.groupBy("block", "key").agg(
        F.ceil(F.count("*") / part).cast("int").alias("parts"))
    split = keyed.join(sizes, ["block", "key"])
    mine = F.pmod(F.xxhash64("print"), "parts").cast("int")
    pieces = (
        split.withColumn("part", mine)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "block", "print", "part",
            # Small pieces are taken up sixteen at a time.
            F.when(F.col("parts") == 1, -1 - F.shiftright("key", 4)).otherwise(F.col("key")).alias("piece"),
            F.least("part", "with").alias("one"), F.greatest("part", "with").alias("other"))
    )
    return pieces.groupBy("block", "piece", "one", "other").applyInPandas(
        _links(budget), "a bigint, b bigint")


def with_components(prints: DataFrame, budget: int = BUDGET, part: int = PART) -> DataFrame:
    """Add ``component`` to the distinct fingerprints of column ``print``: the same value
    for fingerprints that a chain of links joins."""
    found = connected_components(near_links(prints, budget, part))
    return prints.join(found.withColumnRenamed("node", "print"), "print", "left").select(
        "print", F.coalesce("component", "print").alias("component"))


def near_duplicates(documents: DataFrame, budget: int = BUDGET, part: int = PART) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``documents``.

    A text without words (NULL, empty, white space only) has fingerprint zero and is
    linked like any other. Repeated rows stay repeated. ``component_id`` is the smallest
    doc_id of the component, NULL ids left aside; NULL if it has no other.
    """
    spark = documents.sparkSession
    printed = materialise(
        documents.select("doc_id", fingerprint_of(F.col("text")).alias("print")), "prints")
    distinct = materialise(
        printed.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct_prints")
    member = with_components(distinct.select("print"), budget, part)
    labelled = member.join(distinct, "print")
    smallest = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    known = labelled.join(smallest, "component").select("print", "component_id")
    return printed.join(known, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, budget: int = BUDGET, part: int = PART) -> DataFrame:
    """One document of every component, with all its columns: that of the smallest doc_id
    (NULL last, then by text hash and by the other columns' hash)."""
    printed = materialise(documents.select(
        "doc_id", fingerprint_of(F.col("text")).alias("print"), F.xxhash64("text").alias("mark")), "prints")
    member = with_components(printed.select("print").distinct(), budget, part)
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    # Copies have one fingerprint; the best of them is found before anything is joined.
    per_print = printed.groupBy("print").agg(F.min(own).alias("best"))
    kept = per_print.join(member, "print").groupBy("component").agg(F.min("best").alias("best"))
    return only_best(documents, kept)


def only_best(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``documents`` that struct ``best`` (doc_id, mark: text hash) of ``kept``
    names, each once."""
    mark, number, unnumbered, place = fresh(documents, "_mark", "_number", "_unnumbered", "_place")
    # The same columns, never NULL, for the join and the window: texts are shuffled once.
    own = [mark, number, unnumbered]
    doc_id = F.col("best.doc_id")
    named = kept.select(F.col("best.mark").alias(mark), F.coalesce(doc_id, F.lit(0).cast("bigint")).alias(number),
                        doc_id.isNull().alias(unnumbered))
    found = documents.withColumns({
        mark: F.xxhash64("text"), number: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint")),
        unnumbered: F.col("doc_id").isNull()}).join(named, own, "left_semi")
    # Rows with the same id and text are copies of each other.
    copies = Window.partitionBy(*own).orderBy(F.xxhash64(*documents.columns))
    return found.withColumn(place, F.row_number().over(copies)).filter(
        F.col(place) == 1).drop(*own, place)
