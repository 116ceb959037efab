"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from snapmart.session import gathered, scratch_path
from snapmart.sources.files import remove


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rank(node: Column, turn: int) -> Column:
    """Order in which nodes attract others: by value, and by a hash in every other turn.

    By value a star collapses at once; by hash a long chain breaks into short pieces.
    """
    return node if turn % 2 == 0 else F.xxhash64(node, F.lit(turn))


def connected_components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``links`` has two columns of type long. Returns (node, component), one row per
    node that has a link to another; nodes have the same component exactly if a path
    joins them. Its value is one of the nodes.

    In every turn each node points at the best of its neighbours, pointers are followed
    one step further, and every link is replaced by one between the nodes pointed at;
    links within a node disappear. Tables are written to the shared scratch folder, so
    no turn depends on earlier ones being computed again. The last one stays there.
    ``rows``, if known, is about how many links there are.
    """
    spark = links.sparkSession
    root = scratch_path(spark, "components")
    a, b = links.columns
    left = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    left = _written(left if rows is None else gathered(left, rows), f"{root}/links0")
    turn, pointers, first_size = 0, [], left.count()
    size = first_size
    while size:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(
            F.min(F.struct(_rank(F.col("b"), turn).alias("rank"), F.col("b").alias("to"))).alias("best"))
        own = F.struct(_rank(F.col("node"), turn).alias("rank"), F.col("node").alias("to"))
        first = near.select("node", F.least("best", own)["to"].alias("to"))
        ahead = first.select(F.col("node").alias("to"), F.col("to").alias("next"))
        pointer = _written(
            gathered(first.join(ahead, "to").select("node", F.col("next").alias("to")), 2 * size),
            f"{root}/pointers{turn}")
        pointers.append(pointer)
        at_a = pointer.select(F.col("node").alias("a"), F.col("to").alias("new_a"))
        at_b = pointer.select(F.col("node").alias("b"), F.col("to").alias("new_b"))
        moved = left.join(at_a, "a").join(at_b, "b").select(
            F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        turn += 1
        left = _written(gathered(moved.filter("a < b").distinct(), size), f"{root}/links{turn}")
        size = left.count()
    if not pointers:
        return spark.createDataFrame([], "node bigint, component bigint")
    found = pointers[0].withColumnRenamed("to", "component")
    for pointer in pointers[1:]:
        step = pointer.select(F.col("node").alias("component"), F.col("to").alias("next"))
        found = found.join(step, "component", "left").select(
            "node", F.coalesce("next", "component").alias("component"))
    result = _written(gathered(found, 2 * first_size), scratch_path(spark, "component_of"))
    remove(spark, root)
    return result
