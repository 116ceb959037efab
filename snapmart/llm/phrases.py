"""Collocations by prefix-free parsing.

Every piece of text is cut in front of trigger words, chosen by their hash, so equal
passages are cut alike wherever they stand. A chunk owns the words from one cut to the
next and carries the following three besides, so a phrase of up to four words that begins
in what a chunk owns lies whole within it, and is counted in no other. The parse of the
corpus is kept as a dictionary of distinct chunks with their frequencies; phrases are
counted inside distinct chunks, weighted by these.

Phrases are counted from two words to four. A phrase can only be frequent if the two
shorter ones it begins and ends with are; Bloom filters of bounded size of the frequent
ones keep others from being counted. What they let through by mistake is dropped by its
exact count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.llm import bloom
from snapmart.session import materialise

LONGEST = 4
LEAST = 30
SCALE = 2_000_000
# A phrase goes if a longer one holds this share of its occurrences, in percent.
COVERED = 80
BEST = 2_000
NO_LANGUAGE = "und"
# One of so many words is a trigger. Without one, a chunk ends after MAX_OWNED words.
TRIGGER = 16
MAX_OWNED = 64
# Bytes of text cut into chunks at once, and chunks counted at once.
BLOCK = 1 << 21
CHUNKS = 100_000
# The best phrases are first picked among so many parts of a language.
PARTS = 32

_BREAK = re.compile(rb"[.,;:!?\x0a-\x0d]")
# What each byte is: 0 part of a word, 1 a gap between words, 2 the end of a piece.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
# Bytes' hashes (none for the space that ends a word) and factors for their places.
_BYTES, _PLACES = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[0x20] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = "lang string, chunk binary, owned int"


def _word_hashes(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of every word; words lie one after the other, ``sizes`` bytes each."""
    if not len(begins):
        return np.zeros(0, dtype=np.uint64)
    place = np.arange(len(data)) - np.repeat(begins, sizes)
    return np.add.reduceat(_BYTES[data] * _PLACES[place & 255], begins)


def cut_into_chunks(parts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(part, chunk, owned words) of all chunks of lower-cased ``parts`` of text, as arrays.

    A chunk is its words joined by single spaces: those it owns, and up to three more.
    """
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    before = np.concatenate(([False], inside[:-1]))
    at, after = np.flatnonzero(inside & ~before), ~inside & before
    n = len(at)
    # All words, each with one space behind it.
    kept = inside | after
    clean = np.where(after, np.uint8(0x20), data)[kept]
    sizes = np.flatnonzero(after) - at + 1
    begins = np.cumsum(sizes) - sizes
    piece = np.cumsum(kind == 2)[at]
    first = np.concatenate(([True], piece[1:] != piece[:-1]))[:n]
    cut = first | (bloom.mixed(_word_hashes(clean, begins, sizes)) % np.uint64(TRIGGER) == 0)
    place = np.arange(n)
    cut |= (place - np.maximum.accumulate(np.where(cut, place, 0))) % MAX_OWNED == 0
    cuts = np.flatnonzero(cut)
    owned = np.diff(cuts, append=n)
    pieces = np.flatnonzero(first)
    ends = np.append(pieces[1:], n)[np.cumsum(first)[cuts] - 1]
    last = np.minimum(cuts + owned + LONGEST - 1, ends) - 1
    lengths = begins[last] + sizes[last] - 1 - begins[cuts]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    taken = clean[np.arange(offsets[-1]) + np.repeat(begins[cuts] - offsets[:-1], lengths)]
    chunks = pa.Array.from_buffers(
        pa.binary(), len(cuts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(taken)])
    starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
    return np.searchsorted(starts, at[cuts], side="right") - 1, chunks, owned


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list[str], list[bytes]]]:
    """Languages and texts of a few megabytes at a time; longer texts are cut between pieces."""
    langs, parts, size = [], [], 0
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        text, start = (text.as_py() or b"").lower(), 0
        while start < len(text):
            end = len(text)
            if end - start > BLOCK and (found := _BREAK.search(text, start + BLOCK)):
                end = found.end()
            langs.append(lang)
            parts.append(text[start:end])
            start, size = end, size + end - start
            if size >= BLOCK:
                yield langs, parts
                langs, parts, size = [], [], 0
    if parts:
        yield langs, parts


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for langs, parts in _blocks(batch):
            part, chunks, owned = cut_into_chunks(parts)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array(langs, pa.string()).take(pa.array(part)), "chunk": chunks,
                "owned": pa.array(owned, pa.int32())})


def parse(documents: DataFrame) -> DataFrame:
    """(lang, chunk, owned, n): the dictionary of distinct chunks of whole texts and how
    often each occurs. NULL texts have none; a NULL lang is ``und``."""
    texts = documents.select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_parsed, _CHUNK).groupBy("lang", "chunk", "owned").agg(F.count("*").alias("n"))


class _Words:
    """The words of a batch of chunks, in one row, with numbers for distinct ones."""

    def __init__(self, langs: pa.Array, chunks: pa.Array):
        listed = pc.split_pattern(pc.cast(chunks, pa.string()), " ")
        self.ends = listed.offsets.to_numpy()[1:].astype(np.int64) - listed.offsets[0].as_py()
        self.sizes = np.diff(self.ends, prepend=0)
        self.starts = self.ends - self.sizes
        coded = pc.dictionary_encode(listed.flatten())
        self.names, self.word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        langs = pc.dictionary_encode(langs)
        self.lang_names, self.lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)
        # Hashes do not depend on the batch.
        self.word_hash = _digests(self.names)
        self.lang_hash = _digests(self.lang_names)

    def places(self, owned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every owned place with its chunk."""
        chunk = np.repeat(np.arange(len(owned)), owned)
        return self.starts[chunk] + np.arange(len(chunk)) - np.repeat(np.cumsum(owned) - owned, owned), chunk

    def hashes(self, at: np.ndarray, chunk: np.ndarray, length: int) -> np.ndarray:
        """Hash of the phrase of ``length`` words at each place, and its language."""
        out = self.lang_hash[self.lang[chunk]]
        for i in range(length):
            out = out * _STEP + self.word_hash[self.word[at + i]]
        return out


def _digests(names: pa.Array) -> np.ndarray:
    """Hashes of distinct names."""
    offsets = np.frombuffer(names.buffers()[1], np.int32)[names.offset:names.offset + len(names) + 1].astype(np.int64)
    out, some = np.zeros(len(names), dtype=np.uint64), np.flatnonzero(np.diff(offsets))
    if len(some):
        data = np.frombuffer(names.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        out[some] = _word_hashes(data, offsets[some] - offsets[0], np.diff(offsets)[some])
    return out


def _numbered(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(a row of each distinct code, its number per row, how many)."""
    most = int(code.max(initial=0)) + 1
    if most > 8 * len(code) + 1024:
        _, rows, number = np.unique(code, return_index=True, return_inverse=True)
        return rows, number, len(rows)
    # Small codes are told apart by a table instead of sorting.
    row = np.full(most, -1)
    row[code[::-1]] = np.arange(len(code))[::-1]
    used = np.flatnonzero(row >= 0)
    number = np.zeros(most, dtype=np.int64)
    number[used] = np.arange(len(used))
    return row[used], number[code], len(used)


def _many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to CHUNKS rows or more, as the larger one is the fewer words come up again."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNKS:
            yield pa.concat_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def _phrases(length: int, filter_):
    """Maps chunks to (lang, phrase, n), summed within a batch. ``filter_`` holds the frequent
    phrases that are a word shorter; None for single words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _many(batches):
            own = _Words(batch.column(0), batch.column(1))
            at, chunk = own.places(batch.column(2).to_numpy().astype(np.int64))
            if length > 1:
                inside = at + length <= own.ends[chunk]
                at, chunk = at[inside], chunk[inside]
                for shift in (0, 1):
                    likely = bloom.passes(filter_.value[0], own.hashes(at + shift, chunk, length - 1))
                    at, chunk = at[likely], chunk[likely]
            # Numbers for distinct phrases, made of exact numbers for their parts.
            code, first, kinds = own.lang[chunk], None, 0
            for i in range(length):
                first, code, kinds = _numbered(code * len(own.names) + own.word[at + i])
            totals = np.zeros(kinds, dtype=np.int64)
            np.add.at(totals, code, batch.column(3).to_numpy()[chunk])
            parts = [own.names.take(pa.array(own.word[at[first] + i])) for i in range(length)]
            yield pa.RecordBatch.from_pydict({
                "lang": own.lang_names.take(pa.array(own.lang[chunk[first]])),
                "phrase": pc.binary_join_element_wise(*parts, " ") if length > 1 else parts[0],
                "n": pa.array(totals)})

    return count


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            own = _Words(batch.column(0), batch.column(1))
            chunk, out = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.uint64)
            for size in np.unique(own.sizes):
                some = np.flatnonzero(own.sizes == size)
                out[some] = own.hashes(own.starts[some], chunk[some], int(size))
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(np.zeros(len(out), np.int32)), "hash": pa.array(out.view(np.int64))})


def frequent_phrases(dictionary: DataFrame, least: int = LEAST,
                     max_bits: int = bloom.MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, length, phrase, n) of all phrases of one to four words that occur ``least``
    times or more, and (lang, n) with all words of each language.

    ``dictionary`` is read once for each length and should be a stored table.
    """
    spark = dictionary.sparkSession
    columns = dictionary.select("lang", "chunk", "owned", "n")
    words = materialise(columns.mapInArrow(_phrases(1, None), "lang string, phrase string, n bigint")
                        .groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "word_counts")
    everything = words.groupBy("lang").agg(F.sum("n").alias("n"))
    level = words.filter(F.col("n") >= least)
    found = level.withColumn("length", F.lit(1))
    for length in range(2, LONGEST + 1):
        keys = level.select("lang", "phrase").mapInArrow(_keys, "shard int, hash bigint")
        blocks = bloom.block_counts({0: level.count()}, max_bits)
        filter_ = spark.sparkContext.broadcast(bloom.build(keys, blocks))
        level = materialise(
            columns.mapInArrow(_phrases(length, filter_), "lang string, phrase string, n bigint")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least), f"phrases{length}")
        found = found.unionByName(level.withColumn("length", F.lit(length)))
    return found.select("lang", "length", "phrase", "n"), everything


def _big(column: Column) -> Column:
    return column.cast("decimal(25,0)")


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def _scored(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """Add (l, r, score) of the lowest-scoring cut of every candidate."""
    cut = candidates.select("lang", "phrase", "a", "length", "words", F.explode(
        F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"),
                     _part(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"))
    # Parts of a frequent phrase are at least as frequent, so both are found.
    one = frequent.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    other = frequent.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    score = F.expr(f"(cast(a as decimal(25,0)) * {SCALE}BD) div (cast(l as decimal(25,0)) + cast(r as decimal(25,0)))")
    return cut.join(one, ["lang", "first"]).join(other, ["lang", "rest"]).withColumn("score", score).groupBy(
        "lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _covered(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, most): phrases within a longer candidate and its largest count."""
    longer = candidates.filter("length > 2")
    spans = [F.struct(F.lit(start).alias("start"), F.lit(size).alias("size"))
             for size in range(2, LONGEST) for start in range(1, LONGEST - size + 2)]
    inner = longer.select("lang", "words", "length", "a", F.explode(F.array(*spans)).alias("span")).filter(
        (F.col("span.size") < F.col("length")) & (F.col("span.start") + F.col("span.size") - 1 <= F.col("length")))
    return inner.select("lang", _part(F.col("span.start"), F.col("span.size")).alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("most"))


def collocations(documents: DataFrame, least: int = LEAST, best: int = BEST,
                 max_bits: int = bloom.MAX_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language.

    Texts are lower-cased (A-Z) and split into pieces at ``.,;:!?`` and line ends, pieces
    into words at spaces and tabs. Candidates are phrases of two to four words within a
    piece that occur ``least`` times or more, scored by their weakest cut; those that a
    longer candidate covers are left out. NULL texts are empty, a NULL lang is ``und``;
    repeated rows count again, and no documents give no rows.
    """
    frequent, everything = frequent_phrases(materialise(parse(documents), "chunks"), least, max_bits)
    candidates = frequent.filter("length > 1").select(
        "lang", "length", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    scored = _scored(candidates, frequent).join(_covered(candidates), ["lang", "phrase"], "left")
    free = scored.filter(F.col("most").isNull() | (_big(F.col("most")) * 100 < _big(F.col("a")) * COVERED))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First the best of each part of a language, so no task gets all of a language's.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = free.withColumn("part", part).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("place") <= best)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.filter(F.col("rank") <= best).join(everything, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
