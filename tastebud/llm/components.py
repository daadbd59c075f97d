"""Connected components of an edge table and blocks of over-large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.llm.common import join_small, staged


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is the smallest node id reachable.

    Alternating large-star and small-star steps, each a grouped minimum and an
    equi-join; every round is a table in the shared folder and the rounds end
    when the edges no longer change.  A node with many edges is a skewed key
    of a plain join, which the adaptive join splits.
    """
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
               "ccedges")
    mark = None
    for _ in range(max_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = staged(large, "cclarge")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = staged(small, "ccsmall")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    # the star edges have one root per node
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def blocked(rows: DataFrame, key: str, row_id: str, cap: int) -> DataFrame:
    """Give every row the cells ``(key, bi, bj)`` in which it meets the other rows of its key.

    A key of at most ``cap`` rows is one cell; a larger one is cut by the hash
    of ``row_id`` into blocks of about ``cap`` rows and every two blocks meet
    in a cell, so each cell holds about ``2 * cap`` rows and all pairs of a key
    meet (those within a block in several cells).  Only keys of more than
    ``cap`` rows are joined back, at most one for ``cap`` rows.
    """
    large = staged(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap), "largekeys")
    many = join_small(rows, large, [key], "left")
    many = many.withColumn("s", F.coalesce(F.ceil(F.col("n") / cap), F.lit(1)).cast("int")).drop("n")
    many = many.withColumn("blk", F.pmod(F.xxhash64(F.col(row_id), F.lit(7)), F.col("s")).cast("int"))
    many = many.withColumn("other", F.explode(F.when(F.col("s") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("s") - 1), lambda j: j != F.col("blk")))))
    return many.withColumn("bi", F.least("blk", "other")).withColumn("bj", F.greatest("blk", "other")).drop("s", "other")
