"""Interaction-table operators: validation, statistics, group profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.functions.numeric import r6, safe_ratio


def implicit(df: DataFrame, user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """``(user_id, item_id, play = 1.0)``."""
    return df.select(user_col, item_col).withColumn("play", F.lit(1.0))


def valid_interactions(inter: DataFrame, catalog: DataFrame, item_col: str = "item_id") -> DataFrame:
    """Rows whose item is in the catalogue (``isin`` -> left-semi join)."""
    return inter.join(catalog.select(item_col), item_col, "left_semi")


def rating_triplets(inter: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                    value_col: str = "play") -> DataFrame:
    """Sparse-matrix build: duplicate (user, item) entries are summed."""
    return inter.groupBy(user_col, item_col).agg(F.sum(value_col).alias("rating"))


def interaction_stats(inter: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                      approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Counts and sparsity ``1 - n / (users * items)`` over users/items that occur.

    ``approx=True`` uses HyperLogLog++ (``approx_count_distinct``, relative
    error ``rsd``): one pass with fixed-size sketches instead of the exact
    distinct aggregation's extra shuffle.
    """
    distinct = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    s = inter.agg(F.count(F.lit(1)).alias("n_interactions"),
                  distinct(user_col).alias("n_users"),
                  distinct(item_col).alias("n_items"))
    return s.withColumn("sparsity", r6(F.lit(1.0) - F.col("n_interactions") /
                                       (F.col("n_users").cast("double") * F.col("n_items"))))


def per_group_distribution(df: DataFrame, group_col: str, label: str | None = None) -> DataFrame:
    """min / mean / median / max of the per-group row counts (two-level aggregation)."""
    counts = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("_c"))
    out = counts.agg(F.count(F.lit(1)).alias("n_groups"), F.min("_c").alias("min"),
                     r6(F.avg("_c")).alias("mean"), r6(F.median("_c")).alias("median"), F.max("_c").alias("max"))
    return out if label is None else out.select(F.lit(label).alias("dataset"), "*")


def group_counts(df: DataFrame, group_col: str, out_col: str = "n") -> DataFrame:
    """``value_counts()`` — null keys skipped like pandas."""
    return df.where(F.col(group_col).isNotNull()).groupBy(group_col).agg(F.count(F.lit(1)).alias(out_col))


def top_groups(df: DataFrame, group_col: str, n: int = 5, out_col: str = "n") -> DataFrame:
    """The ``n`` most frequent values (ties: smaller key first) — a top-k report."""
    return group_counts(df, group_col, out_col).orderBy(F.col(out_col).desc(), F.col(group_col)).limit(n)


def group_share(df: DataFrame, group_col: str) -> DataFrame:
    """Each group's share of all rows; the total is a scalar subquery (no join)."""
    counts = group_counts(df, group_col)
    total = counts.agg(F.sum("n").alias("_total")).scalar()
    return counts.select(group_col, "n", r6(F.col("n") / total).alias("share"))


def user_group_profile(inter: DataFrame, item_groups: DataFrame, user_col: str = "user_id",
                       item_col: str = "item_id", group_col: str = "artist") -> DataFrame:
    """Favourite group per user, row count and the share outside the favourite.

    Favourite = the group with most of the user's rows (ties: smaller group
    name).  Two partial aggregations; no per-user collection of rows.
    """
    per = (inter.join(item_groups.select(item_col, group_col), item_col)
           .groupBy(user_col, group_col).agg(F.count(F.lit(1)).alias("_c")))
    prof = per.groupBy(user_col).agg(
        F.min_by(F.col(group_col), F.struct((-F.col("_c")).alias("a"), F.col(group_col).alias("b")))
        .alias("favorite_group"),
        F.max("_c").alias("_fav"), F.sum("_c").alias("n_items"))
    return prof.select(user_col, "favorite_group", F.col("n_items").cast("long").alias("n_items"),
                       r6(safe_ratio(F.col("n_items") - F.col("_fav"), F.col("n_items"))).alias("noise_ratio"))
