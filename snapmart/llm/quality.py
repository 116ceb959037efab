"""Quality rules: counts per document, and a likelihood ratio between trusted and raw text.

Every document becomes a bag of hashed one- and two-word n-grams. Two multinomials
over the hash buckets are fitted: one to trusted documents, one to the whole corpus.
A document's score is the sum of its n-grams' log ratios divided by their number;
it is kept if the score reaches a fixed threshold. Log ratios are stored as whole
millionths, so that adding them up gives the same score whatever the order.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor, log

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.llm.text import fresh, long_table, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MICRO = 1_000_000


@dataclass(frozen=True)
class Settings:
    """``trusted_docs`` bounds the labelled sample the target is fitted to; the raw
    corpus is counted in full. ``prior`` is the weight, in n-grams, of the assumption
    that a bucket is as frequent in trusted text as in raw text."""

    buckets: int = 65_536  # a power of two
    prior: int = 32
    trusted_docs: int = 8_192
    threshold: float = -0.12
    min_words: int = 20
    max_repeat_percent: int = 30


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c))
    return text


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda word: F.xxhash64(word))


def joined_hashes(hashes: Column, apart: int) -> Column:
    """Hash of each element together with the one ``apart`` places on."""
    return F.transform(
        F.slice(hashes, apart + 1, F.greatest(F.size(hashes) - apart, F.lit(0))),
        lambda later, i: F.xxhash64(F.get(hashes, i), later))


def bucket(code: Column, buckets: int) -> Column:
    return code.bitwiseAND(F.lit(buckets - 1).cast("bigint"))


def trusted_ids(labels: DataFrame, limit: int) -> DataFrame:
    """Ids of at most ``limit`` documents labelled good, picked by a hash of the id."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    return (
        good.select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    )


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[int]:
    """Log ratio of every bucket in millionths; as many numbers as there are buckets.

    All documents count for the raw side. The counts per bucket are summed up before
    the shuffle, so a task sends one row per bucket at most.
    """
    trusted = trusted_ids(labels, settings.trusted_docs).select(
        F.col("doc_id").alias("_trusted"))
    ones, twos = F.col("_ones"), F.col("_twos")
    grams = (
        documents.select("doc_id", word_hashes(F.col("text")).alias("_ones"))
        .withColumn("_twos", joined_hashes(ones, 1))
        # The trusted ids number trusted_docs at most.
        .join(F.broadcast(trusted), F.col("doc_id") == F.col("_trusted"), "left")
        .select(F.col("_trusted").isNotNull().cast("bigint").alias("_good"),
                F.explode(F.concat(ones, twos)).alias("_gram"))
        .select("_good", bucket(F.col("_gram"), settings.buckets).alias("bucket"))
    )
    counts = grams.groupBy("bucket").agg(
        F.count("*").alias("raw"), F.sum("_good").alias("target")).collect()
    raw_total = sum(row["raw"] for row in counts)
    target_total = sum(row["target"] for row in counts)
    ratios = [0] * settings.buckets
    if not target_total:
        return ratios
    share = target_total / raw_total
    for row in counts:
        ratio = log((row["target"] + settings.prior * share)
                    / ((row["raw"] + settings.prior) * share))
        ratios[row["bucket"]] = floor(ratio * MICRO + 0.5)
    return ratios


def base_counts(df: DataFrame, text: str, per_word: str) -> dict[str, Column]:
    """Counts that need no look at neighbouring words."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(per_word).cast("bigint"),
        "word_chars": F.length(_without(whole, " \t\n\x0b\x0c\r")).cast("bigint"),
        "n_symbols": (F.octet_length(whole) - F.octet_length(_without(whole, SYMBOLS))).cast("bigint"),
        "n_dup_lines": F.aggregate(
            F.array(lines), F.lit(0).cast("bigint"),
            lambda _, all_lines: (F.size(all_lines) - F.size(F.array_distinct(all_lines))).cast("bigint")),
    }


def with_repeats(df: DataFrame, pairs: str, out: str) -> DataFrame:
    """Add how many words lie in a window of eight that occurs twice or more.

    ``pairs`` holds a hash of every two neighbouring words; two of them two places
    apart make four words, two of those four places apart a window. Windows are
    compared by that 64-bit hash.
    """
    fours, windows, found, starts = fresh(df, "_fours", "_windows", "_found", "_starts")
    window, seen, start = (F.col(c) for c in (windows, found, starts))
    nothing = F.array().cast("array<struct<hash:bigint,at:int>>")
    return (
        df.withColumn(fours, joined_hashes(F.col(pairs), 2))
        .withColumn(windows, joined_hashes(F.col(fours), 4))
        .withColumn(found, F.when(
            F.size(F.array_distinct(window)) == F.size(window), nothing,
        ).otherwise(F.sort_array(F.transform(
            window, lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))))
        .withColumn(starts, F.sort_array(F.transform(
            F.filter(seen, lambda e, i: F.coalesce(
                (F.get(seen, i - 1)["hash"] == e["hash"])
                | (F.get(seen, i + 1)["hash"] == e["hash"]),
                F.get(seen, i - 1)["hash"] == e["hash"],
                F.get(seen, i + 1)["hash"] == e["hash"], F.lit(False))),
            lambda e: e["at"])))
        # A window reaches to the next one's start, or over its whole length.
        .withColumn(out, F.aggregate(
            F.transform(start, lambda at, i: F.least(
                F.lit(WINDOW), F.coalesce(F.get(start, i + 1) - at, F.lit(WINDOW)))),
            F.lit(0).cast("bigint"), lambda total, n: total + n))
        .drop(fours, windows, found, starts)
    )


def judge(documents: DataFrame, ratios: list[int], settings: Settings = Settings()) -> DataFrame:
    """All columns of ``documents`` and a struct ``_quality`` of counts and verdicts.

    The struct has n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score
    (mean log ratio; NULL without a word), base_failed and kept. A NULL or empty text
    has no words and fails the base rule. No row is added or lost, whatever its id.
    """
    verdict, ones, twos, total, repeats = fresh(
        documents, "_quality", "_ones", "_twos", "_total", "_repeats")
    table = long_table(ratios)

    def add_up(grams: Column, start: Column) -> Column:
        return F.aggregate(grams, start, lambda acc, gram: acc + F.get(
            table, bucket(gram, settings.buckets)))

    counted = (
        documents.withColumn(ones, word_hashes(F.col("text")))
        .withColumn(twos, joined_hashes(F.col(ones), 1))
        .withColumn(total, add_up(F.col(twos), add_up(F.col(ones), F.lit(0).cast("bigint"))))
    )
    counted = with_repeats(counted, twos, repeats)
    base = base_counts(counted, "text", ones)
    n, again = F.size(ones).cast("bigint"), F.col(repeats)
    failed = (n < settings.min_words) | (100 * again > settings.max_repeat_percent * n)
    grams = 2 * n - 1
    passed = F.col(total) >= F.lit(round(settings.threshold * MICRO)) * grams
    return counted.withColumn(verdict, F.struct(
        *[column.alias(name) for name, column in base.items()],
        again.alias("n_repeat_words"),
        F.when(n > 0, F.col(total) / (grams * MICRO)).alias("score"),
        failed.alias("base_failed"),
        (~failed & passed).alias("kept"),
    )).drop(ones, twos, total, repeats)


def quality_counts(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: its id, the counts, the score and the verdicts."""
    judged = judge(documents.select("doc_id", "text"), fit(documents, labels, settings), settings)
    return judged.select("doc_id", "_quality.*")


def keep_good(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that pass, with all their columns."""
    judged = judge(documents, fit(documents, labels, settings), settings)
    verdict = next(c for c in judged.columns if c not in documents.columns)
    (number,) = fresh(judged, "_number")
    # The number keeps the optimiser from moving the filter below the steps that work
    # out the verdict, where each would be repeated for every word.
    return judged.withColumn(number, F.monotonically_increasing_id()).filter(
        F.col(verdict)["kept"] & (F.col(number) >= 0)).drop(verdict, number)
