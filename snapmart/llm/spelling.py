"""Spelling variants: words that one inserted, deleted or replaced letter tells apart.

Every word generates its edits, which are probed against a Bloom filter of the vocabulary
with a shard for each length. Only edits that pass are shuffled to an exact join with the
vocabulary, which removes the false ones. Of two words an edit apart, the longer one
generates the other by a deletion; of two equally long ones, that with the smaller letter
generates the other by a replacement. So each pair comes up once.

Filters have a bounded size. A vocabulary that needs more is taken in rounds, each with
the filter of one class of words by hash, so no round lets more false edits through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapmart.llm import bloom
from snapmart.session import materialise

SHORTEST = 7
LEAST = 2
TIMES = 10
# Every so many-th pair of document and run loses a letter.
NOISE = 31
# Different words a task counts before it passes them on.
HELD = 200_000

_RUN = re.compile(rf"[a-zÀ-ÿ]{{{SHORTEST},}}")
# Letters' hashes and the base of the polynomial; odd, so it has an inverse.
_LETTERS = np.random.Generator(np.random.PCG64(13)).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    return np.array([pow(_BASE, i, 1 << 64) for i in range(n)], dtype=np.uint64)


def _terms(letters: np.ndarray) -> np.ndarray:
    """Each letter's share in its word's hash, for words of one length as rows."""
    return _LETTERS[letters] * _powers(letters.shape[1])


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and letters, as Latin-1 codes, of the words of each length."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        data = "".join([words[i] for i in at]).encode("latin-1")
        yield at, np.frombuffer(data, np.uint8).reshape(len(at), length)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "word": pa.array(list(totals), pa.string()), "n": pa.array(list(totals.values()), pa.int64())})

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            runs = Counter(_RUN.findall((text.as_py() or b"").lower().decode("utf-8", "replace")))
            start = zlib.crc32(b"%s:" % str("" if doc_id is None else doc_id).encode())
            for run, n in runs.items():
                code = zlib.crc32(run.encode(), start)
                if code % NOISE == 0:
                    at = code % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < SHORTEST:
                        continue
                totals[run] += n
            if len(totals) >= HELD:
                yield out()
                totals.clear()
    yield out()


def vocabulary(documents: DataFrame) -> DataFrame:
    """(word, n): the words of whole texts, with A-Z lower-cased, and how often they occur.

    Words are maximal runs of letters; in one of 31 pairs of document and run, by crc32, a
    letter is deleted. Those of seven letters or more that occur twice or more are
    returned. NULL texts have none; a NULL doc_id is written as nothing before the colon.
    """
    texts = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= LEAST)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        hashes = np.zeros(len(words), dtype=np.uint64)
        lengths = np.zeros(len(words), dtype=np.int32)
        for at, letters in _by_length(words):
            hashes[at], lengths[at] = _terms(letters).sum(axis=1, dtype=np.uint64), letters.shape[1]
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array(lengths, pa.int32()), "hash": pa.array(hashes.view(np.int64), pa.int64())})


def _class_of(hashes: np.ndarray, rounds: int) -> np.ndarray:
    return (bloom.mixed(hashes ^ np.uint64(_BASE)) % np.uint64(rounds)).astype(np.int64)


def _probes(filters, alphabet: list[str], turn: int, rounds: int):
    """Maps (word, n) to (word, n, near): edits of the word that the filters let through."""
    letters_used = np.sort(np.frombuffer("".join(alphabet).encode("latin-1"), np.uint8))
    back = np.uint64(pow(_BASE, -1, 1 << 64))

    def hits(length: int, hashes: np.ndarray) -> np.ndarray:
        shard = filters.value.get(length)
        if shard is None:
            return np.zeros(len(hashes), dtype=bool)
        found = bloom.passes(shard, hashes)
        if rounds > 1:
            found[found] = _class_of(hashes[found], rounds) == turn
        return found

    def edits(letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and the letters of their edits."""
        length = letters.shape[1]
        terms, powers = _terms(letters), _powers(length)
        whole = terms.sum(axis=1, dtype=np.uint64)
        before = np.cumsum(terms, axis=1, dtype=np.uint64)
        for at in range(length):
            # Deleting any letter of a run of equal ones gives the same word.
            rows = np.arange(len(letters)) if at == 0 else np.flatnonzero(letters[:, at] != letters[:, at - 1])
            left = before[rows, at] - terms[rows, at] + (whole[rows] - before[rows, at]) * back
            rows = rows[hits(length - 1, left)]
            if len(rows):
                yield rows, np.delete(letters[rows], at, axis=1)
            rows, which = np.nonzero(letters_used[None, :] > letters[:, at, None])
            new = letters_used[which]
            changed = whole[rows] + (_LETTERS[new] - _LETTERS[letters[rows, at]]) * powers[at]
            found = hits(length, changed)
            if found.any():
                rows, other = rows[found], letters[rows[found]]
                other[:, at] = new[found]
                yield rows, other

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            own, near = [], []
            for at, letters in _by_length(words):
                for rows, other in edits(letters):
                    own.append(at[rows])
                    text, length = other.tobytes().decode("latin-1"), other.shape[1]
                    near += [text[i:i + length] for i in range(0, len(text), length)]
            taken = pa.array(np.concatenate(own) if own else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), counts.take(taken), pa.array(near, pa.string())], ["word", "n", "near"])

    return probe


def near_pairs(words: DataFrame, max_bits: int = bloom.MAX_BITS) -> DataFrame:
    """(word, n, near, near_n): all pairs of ``words`` (word, n) that are an edit apart,
    each pair once. ``words`` is read several times and should be a stored table."""
    spark = words.sparkSession
    sizes = {r["length"]: r["words"] for r in words.groupBy(F.length("word").alias("length")).agg(
        F.count("*").alias("words")).collect()}  # one row per length
    # One row per letter: 90 at most.
    alphabet = [r[0] for r in words.select(F.explode(F.split("word", ""))).distinct().collect() if r[0]]
    rounds = max(1, -(-sum(sizes.values()) * bloom.BITS_PER_KEY // max_bits))
    hashed = words.select("word").mapInArrow(_hashed, "shard int, hash bigint")
    found = None
    for turn in range(rounds):
        if rounds == 1:
            own, blocks = hashed, bloom.block_counts(sizes, max_bits)
        else:
            own = hashed.mapInArrow(_of_class(turn, rounds), "shard int, hash bigint")
            blocks = bloom.block_counts({k: -(-n // rounds) for k, n in sizes.items()}, max_bits)
        filters = spark.sparkContext.broadcast(bloom.build(own, blocks))
        some = words.mapInArrow(_probes(filters, alphabet, turn, rounds), "word string, n bigint, near string")
        found = some if found is None else found.unionByName(some)
    if found is None:
        return spark.createDataFrame([], "word string, n bigint, near string, near_n bigint")
    return found.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select(
        "word", "n", "near", "near_n")


def _of_class(turn: int, rounds: int):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(_class_of(hashes, rounds) == turn))

    return pick


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for the rows of ``links`` (word, form): the end of the chain of forms.

    A form is ten times as frequent as its word, so chains are short; each turn follows
    twice as many links at once.
    """
    found = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialise(found.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        found = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return found


def variants(documents: DataFrame, max_bits: int = bloom.MAX_BITS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary.

    ``form`` is the most frequent word an edit apart (ties: the first in code-point
    order) if it is at least ten times as frequent, else NULL; ``root`` is the last of the
    chain of forms, the word itself if it has none. No documents give no rows; repeated
    rows count as often as they occur.
    """
    words = materialise(vocabulary(documents), "words")
    pairs = near_pairs(words, max_bits)
    sides = pairs.select(F.explode(F.array(
        F.struct("word", F.col("near").alias("other"), F.col("near_n").alias("other_n")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))).alias("s"))
    near = sides.select("s.*").groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best"))
    enough = -F.col("best.less") >= TIMES * F.col("n")
    formed = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(formed.filter(F.col("form").isNotNull()).select("word", "form"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
