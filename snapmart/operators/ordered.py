"""Operators over a long order: neighbours, rolling frames, running totals, ranks.

A window puts each group into one task. Where a group may be too large for that
(or, with no grouping at all, where the whole input is one group), rows are cut
into contiguous slices of the order by a range partitioning. Each slice is worked
on alone and only the rows next to a cut, or one total per slice, are brought
together afterwards. Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from snapmart.session import materialise, scratch_dir

_SLICE, _POSITION, _LENGTH = "_slice", "_position", "_length"


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sliced(df: DataFrame, order: Sequence[Column], slices: int | None) -> DataFrame:
    return (
        df.repartitionByRange(slices or _shuffle_partitions(df), *order)
        .withColumn(_SLICE, F.spark_partition_id())
    )


def over_history(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    back: int = 0,
    ahead: int = 0,
    sliced: bool = True,
    slices: int | None = None,
) -> DataFrame:
    """Add window columns that look at most ``back`` rows back and ``ahead`` rows on.

    ``columns`` maps the window of one key, ordered by ``order``, to named columns.
    ``order`` should end in a unique column. ``sliced=False`` takes a plain window, for
    histories of which each is known to fit a task; the choice does not depend on the
    data. Slices go through a table in the scratch area (see :func:`scratch_scope`).
    """
    scratch_dir(df.sparkSession)  # a missing setting shows on either path
    history = Window.partitionBy(*keys).orderBy(*order)
    if not sliced:
        return df.withColumns(columns(history))

    near = back + ahead
    slices = slices or _shuffle_partitions(df)
    total_order = [F.col(c) for c in (*keys, *order)]
    in_slice = Window.partitionBy(_SLICE).orderBy(*total_order)
    within = Window.partitionBy(_SLICE, *keys).orderBy(*order)
    done = materialise(
        _sliced(df, total_order, slices)
        .withColumns({_POSITION: F.row_number().over(in_slice), **columns(within)}),
        "history",
    )
    # One row per slice.
    lengths = done.groupBy(_SLICE).agg(F.max(_POSITION).alias(_LENGTH))
    placed = done.join(F.broadcast(lengths), _SLICE)

    from_end = F.col(_LENGTH) - F.col(_POSITION)
    at_cut = (F.col(_POSITION) <= back) | (from_end < ahead)
    # Every neighbour a row at a cut looks at lies within this band, which holds at
    # most 2 * near rows per slice.
    band = placed.filter((F.col(_POSITION) <= near) | (from_end < near))
    repaired = band.select(*df.columns, at_cut.alias("_cut")).withColumns(columns(history))
    inner = placed.filter(~at_cut)
    names = df.columns + [c for c in done.columns if c not in (*df.columns, _SLICE, _POSITION)]
    return inner.select(*names).unionByName(repaired.filter("_cut").select(*names))


def over_time(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    seconds: int,
    columns: Callable[[WindowSpec], dict[str, Column]],
    sliced: bool = True,
    slices: int | None = None,
) -> DataFrame:
    """Add window columns over the rows of a key within the last ``seconds`` before each row.

    The frame holds what is less than ``seconds`` older, the row itself and all rows of
    the same time. Rows without a time see each other only. ``sliced`` as in
    :func:`over_history`; here a slice is also given the earlier rows that frames of its
    first key reach back to. That band is bounded by time, not by a number of rows, and
    may come from several slices before. Rows of one key and one time stay together.
    """
    scratch_dir(df.sparkSession)
    micros, own, first = "_micros", "_own", "_first"
    reach = seconds * 1_000_000
    timed = df.withColumn(micros, F.unix_micros(F.col(time).cast("timestamp")))
    if not sliced:
        frame = Window.partitionBy(*keys).orderBy(micros).rangeBetween(1 - reach, 0)
        return timed.withColumns(columns(frame)).drop(micros)

    done = materialise(_sliced(timed, [F.col(c) for c in (*keys, micros)], slices), "over_time")
    # One row per slice: the key and time it begins with.
    starts = done.groupBy(_SLICE).agg(F.min(F.struct(*keys, micros)).alias(first)).select(
        F.col(_SLICE).alias("_later"), *[F.col(f"{first}.{k}").alias(f"_first_{k}") for k in keys],
        F.col(f"{first}.{micros}").alias("_from"))
    reached = [F.equal_null(F.col(k), F.col(f"_first_{k}")) for k in keys]
    reached += [F.col(_SLICE) < F.col("_later"), F.col(micros) > F.col("_from") - reach]
    band = done.join(F.broadcast(starts), reached).select(
        *df.columns, micros, F.col("_later").alias(_SLICE), F.lit(False).alias(own))
    frame = Window.partitionBy(_SLICE, *keys).orderBy(micros).rangeBetween(1 - reach, 0)
    both = done.select(*df.columns, micros, _SLICE, F.lit(True).alias(own)).unionByName(band)
    return both.withColumns(columns(frame)).filter(own).drop(micros, _SLICE, own)


def running_total(
    df: DataFrame, value: str, order: Sequence[Column], out: str, slices: int | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of ``order`` to the current one.

    ``order`` must be total. ``value`` should be an integer or a decimal, so that
    adding slice by slice changes nothing.
    """
    in_slice = Window.partitionBy(_SLICE).orderBy(*order)
    upto = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = materialise(
        _sliced(df, order, slices).withColumn("_partial", F.sum(value).over(upto)), "running")
    # One row per slice, so a single task adds them up.
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        done.groupBy(_SLICE).agg(F.sum(value).alias("_sum"))
        .select(_SLICE, F.sum("_sum").over(before).alias("_start"))
    )
    # NULLs add nothing; the total stays NULL until the first value, as in a plain window.
    total = F.coalesce(F.col("_start") + F.col("_partial"), F.col("_partial"), F.col("_start"))
    return done.join(F.broadcast(starts), _SLICE).select(*df.columns, total.alias(out))


def rank_descending(df: DataFrame, value: str, out: str, slices: int | None = None) -> DataFrame:
    """RANK over all rows by ``value``, largest first, NULL last, gaps after ties.

    Ranks are worked out on the distinct values, so a value shared by many rows is
    one row by then.
    """
    counts = df.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_rows"))
    ranks = running_total(
        counts, "_rows", [F.col("_value").desc_nulls_last()], "_upto", slices,
    ).select("_value", (F.col("_upto") - F.col("_rows") + 1).alias(out))
    return df.join(ranks, F.equal_null(F.col(value), F.col("_value"))).drop("_value")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows of ``order``."""
    return df.orderBy(*order).limit(n)
