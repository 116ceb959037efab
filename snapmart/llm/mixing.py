"""Mixing sources to target weights.

The words of every source, documents in order, are packed into blocks of a fixed
length. Every source gets a number of block slots in proportion to its target. Slots
are dealt to output shards by a pseudorandom permutation of all slots: the counts of a
shard are multinomial draws with the targets as weights, under the condition that over
all shards every source gets its number, so that each meets its target to within a
block. Within a source, slot k takes block perm(k modulo blocks) of pass k / blocks, and
slots and blocks are joined by that index. No block is taken twice in a pass, and no
source has more than three passes, so no document is taken more than three times over.

The permutations are swap-or-not shuffles: in each round, x and its mirror image
(key - x) modulo n change places or do not, as a hash of the larger of the two says.
They need no state and work for any n. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapmart.llm.text import fresh, words
from snapmart.session import gathered, materialise

# Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
MAX_TIMES = 3
BLOCK = 64
SHARD_SLOTS = 4_096
ROUNDS = 12
SEED = 20_240
# Slots that one row makes at once.
_RUN = 4_096
_PRIME = 2_147_483_647


def _scramble(value: Column, salt: Column | int) -> Column:
    """A number below 2**31 - 1 from two others, by squaring modulo a prime.

    Plain integer arithmetic, so that SQL engines agree on it.
    """
    mixed = (value % _PRIME * 48_271 + salt) % _PRIME
    squared = (mixed * mixed + 16_807 + salt) % _PRIME
    return (squared * 69_621 + mixed) % _PRIME


def round_keys(salt: Column) -> Column:
    """One number per round, of about 62 bits."""
    return F.transform(
        F.sequence(F.lit(1).cast("bigint"), F.lit(ROUNDS).cast("bigint")),
        lambda turn: _scramble(salt * 31 + turn, SEED) * F.lit(_PRIME).cast("bigint")
        + _scramble(salt * 37 + turn, SEED + 1))


def permuted(place: Column, size: Column, keys: Column) -> Column:
    """Where ``place`` goes in a permutation of 0 .. size - 1 that ``keys`` selects."""
    def swap(x: Column, key: Column) -> Column:
        mirror = F.pmod(key % size - x, size)
        change = _scramble(F.greatest(x, mirror) + key % _PRIME, SEED + 2) % 2 == 1
        return F.when(change, mirror).otherwise(x)

    return F.aggregate(keys, place, swap)


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight, target) from rows of (source, size).

    Sources by code point, NULL last, have the fixed weights in turn and share all
    sizes. Targets end at three times the source's size; the rest is shared among the
    others by weight until no target is above. One row per source: a window over all of
    them is one task of as many rows as there are sources.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("rank", F.row_number().over(in_order)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") - 1) % len(WEIGHTS) + 1))
    # Sources reach their limit in order of limit per weight. With those before a source
    # at their limits, one weight is worth `level` words; the first source that can take
    # its share at that level shows where to stop.
    limit = MAX_TIMES * F.col("source_size")
    full_first = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    all_in_order = full_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = full_first.rowsBetween(Window.unboundedPreceding, -1)
    after = full_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = weighed.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        / F.sum("weight").over(after)
    ).withColumn("level", F.when(F.col("level") * F.col("weight") <= limit, F.col("level")))
    return levels.withColumn("level", F.first("level", ignorenulls=True).over(all_in_order)).select(
        "source", "source_size", "rank", "weight",
        F.least(F.col("level") * F.col("weight"), limit.cast("double")).alias("target"))


def _starts(sized: DataFrame, rows: int) -> DataFrame:
    """Add ``start``: words of the same source in documents before this one.

    Documents are ordered by id (NULL last), size and text hash. Slices of that order
    are added up one by one, then their totals, so a large source is not one task. They
    are numbered before they are gathered in files for ``rows`` rows.
    """
    order = [F.col("rank"), F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("mark")]
    partitions = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialise(gathered(
        sized.repartitionByRange(partitions, *order).withColumn("slice", F.spark_partition_id()), rows), "slices")
    within = Window.partitionBy("slice", "rank").orderBy(*order[1:])
    upto = within.rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice and source in it.
    totals = sliced.groupBy("slice", "rank").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("slice", "rank", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    return (
        sliced.withColumn("inside", F.coalesce(F.sum("size").over(upto), F.lit(0)))
        .join(offsets, ["slice", "rank"])
        .withColumn("start", F.col("offset") + F.col("inside"))
        .drop("slice", "offset", "inside")
    )


def _slots(targets: DataFrame, block: int) -> DataFrame:
    """(rank, block_no, pass, shard): one row per slot of the mix."""
    size = F.col("source_size")
    everything = Window.partitionBy()
    n_blocks = F.ceil(size / block)
    # A pass over a source has `source_size` words in `n_blocks` blocks.
    wanted = F.least(
        F.floor(F.col("target") * n_blocks / size + 0.5), MAX_TIMES * n_blocks).cast("bigint")
    counts = (
        targets.filter(size > 0)
        .withColumn("n_blocks", n_blocks).withColumn("slots", wanted)
        .withColumn("all_slots", F.sum("slots").over(everything))
        .withColumn("first", F.sum("slots").over(Window.orderBy("rank")) - F.col("slots"))
        .filter("slots > 0")
    )
    runs = counts.withColumn("run", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("slots") - 1, F.lit(_RUN).cast("bigint"))))
    # A large source is many runs; they are spread before each becomes its slots.
    partitions = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = (
        runs.repartition(partitions, "rank", "run")
        .withColumns({"block_keys": round_keys(F.col("rank").cast("bigint")),
                      "shard_keys": round_keys(F.lit(0).cast("bigint"))})
        .withColumn("slot", F.explode(F.sequence(
            F.col("run"), F.least(F.col("run") + _RUN, F.col("slots")) - 1)))
        .withColumn("pass", F.floor(F.col("slot") / F.col("n_blocks")))
    )
    # Every pass starts elsewhere in the order.
    place = (F.col("slot") + F.col("pass") * 7_919) % F.col("n_blocks")
    return slots.select(
        "rank", permuted(place, F.col("n_blocks"), F.col("block_keys")).alias("block_no"), "pass",
        F.floor(permuted(F.col("first") + F.col("slot"), F.col("all_slots"), F.col("shard_keys"))
                / SHARD_SLOTS).alias("shard"))


def _sized(documents: DataFrame, row: Column) -> DataFrame:
    return materialise(documents.select(
        row.alias("row"), "doc_id", "source", F.xxhash64("text").alias("mark"),
        F.size(words(F.col("text"))).cast("bigint").alias("size")), "sizes")


def _planned(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    targets = materialise(source_targets(sized.select("source", "size")), "targets")
    placed = _starts(sized.join(
        targets, F.equal_null(sized["source"], targets["source"])
    ).select(*[sized[c] for c in sized.columns], "rank", "source_size", "target"), sized.count())
    return placed, targets


def _drawn(placed: DataFrame, targets: DataFrame, block: int) -> DataFrame:
    """(row, pass, shard, from_word, n): the words of a document that each slot takes."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = placed.filter("size > 0").select(
        "row", "rank", "start", "size", F.explode(F.sequence(first, last)).alias("block_no"))
    begin = F.greatest("start", F.col("block_no") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block_no") + 1) * block)
    pieces = pieces.select(
        "row", "rank", "block_no", (begin - F.col("start")).alias("from_word"), (end - begin).alias("n"))
    # Spark takes slots for a small table, as they are made from one row per source; without
    # the hint it would broadcast them all.
    return pieces.join(_slots(targets, block).hint("merge"), ["rank", "block_no"]).select(
        "row", "pass", "shard", "from_word", "n")


def mixed_sizes(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``documents``.

    ``taken`` counts the words the mix takes from the row, repeats included; 0 for a
    NULL or empty text. Rows with equal or NULL ids each have a row of their own.
    """
    placed, targets = _planned(_sized(documents, F.monotonically_increasing_id()))
    taken = _drawn(placed, targets, block).groupBy("row").agg(F.sum("n").alias("taken"))
    return placed.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"))


def slots_by_shard(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """(shard, source, slots): how many blocks each output shard draws from each source."""
    _, targets = _planned(_sized(documents, F.monotonically_increasing_id()))
    return _slots(targets, block).groupBy("shard", "rank").agg(F.count("*").alias("slots")).join(
        targets.select("rank", "source"), "rank").select("shard", "source", "slots")


def mix(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents as far as the mix takes them, with all their columns.

    ``text`` becomes the words taken, a line for each pass: the text as it is where a
    pass takes all of it, else the words taken in order, single spaces between them.
    ``n_chars``, if there is such a column, follows. Documents of which nothing is taken
    do not appear; repeated rows are taken each for itself.
    """
    row, word_list, taken_runs = fresh(documents, "_row", "_words", "_runs")
    # The number of a row has to stay the same in all that follows.
    numbered = materialise(documents.withColumn(row, F.monotonically_increasing_id()), "numbered")
    placed, targets = _planned(_sized(numbered, F.col(row)))
    drawn = _drawn(placed, targets, block).groupBy(F.col("row").alias(row)).agg(
        F.sort_array(F.collect_list(F.struct("pass", "from_word", "n"))).alias(taken_runs))
    rows = numbered.join(drawn, row).withColumn(word_list, words(F.col("text")))

    def in_pass(number: int) -> Column:
        runs = F.filter(taken_runs, lambda run: run["pass"] == number)
        n_words = F.aggregate(runs, F.lit(0).cast("bigint"), lambda total, run: total + run["n"])
        part = F.array_join(F.flatten(F.transform(runs, lambda run: F.slice(
            F.col(word_list), (run["from_word"] + 1).cast("int"), run["n"].cast("int")))), " ")
        return F.when(n_words == F.size(word_list), F.col("text")).when(n_words > 0, part)

    text = F.array_join(F.array(*map(in_pass, range(MAX_TIMES))), "\n")
    kinds = dict(documents.dtypes)
    mixed = rows.withColumn("text", text)
    if "n_chars" in kinds:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(kinds["n_chars"]))
    return mixed.select(*documents.columns)
