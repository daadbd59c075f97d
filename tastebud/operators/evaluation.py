"""Ranking metrics (Precision / Recall / NDCG at several K) and the leaderboard.

One pass for all K: recs up to max(K) are joined with the truth set on
(user, item) — a key with no skew — each hit is fanned out to the K values
whose cut it survives, and a single aggregation per (model, user, K) yields
hits and DCG.  Users are evaluated when they have truth *and* at least one
rec; users without recs are left out rather than counted as zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastebud.functions.numeric import ideal_dcg, log_discount, r6

DEFAULT_KS = (5, 10, 20)


def compact_ranks(recs: DataFrame, user_col: str = "user_id", rank_col: str = "rank",
                  group_cols: tuple[str, ...] = ("model",), tie_col: str | None = None) -> DataFrame:
    """Positions 1..n per (model, user) after dropping rank holes.

    A duplicated (user, rank) keeps one row — the last by ``tie_col`` when
    given (the reference's "last row wins"), else the largest item id.
    Per-user rec lists are bounded by K, so the per-user window is bounded too.
    """
    keys = [c for c in group_cols if c in recs.columns] + [user_col]
    last = F.col(tie_col).desc() if tie_col else F.col("item_id").desc()
    # One shuffle on (model, user) serves both windows below.
    dedup = (recs.repartition(*keys)
             .withColumn("_d", F.row_number().over(Window.partitionBy(*keys, rank_col).orderBy(last)))
             .where(F.col("_d") == 1).drop("_d"))
    return dedup.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy(rank_col)))


def per_user_metrics(recs: DataFrame, truth: DataFrame, ks=DEFAULT_KS, user_col: str = "user_id",
                     item_col: str = "item_id", model_col: str = "model") -> DataFrame:
    """``(model, user_id, K, hits, n_truth, precision, recall, ndcg)`` per eligible user.

    ``recs`` needs ``model, user_id, item_id, pos`` (see :func:`compact_ranks`);
    a repeated item in a rec list counts at each position, as in the reference.
    """
    ks = sorted(set(int(k) for k in ks))
    max_k = ks[-1]
    truth_set = truth.select(user_col, item_col).distinct()
    n_truth = truth_set.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_truth"))
    k_arr = F.array(*[F.lit(k) for k in ks])

    hits = (recs.where(F.col("pos") <= F.lit(max_k))
            .select(model_col, user_col, item_col, "pos")
            .join(truth_set, [user_col, item_col])
            .withColumn("K", F.explode(F.filter(k_arr, lambda k: F.col("pos") <= k)))
            .groupBy(model_col, user_col, "K")
            .agg(F.count(F.lit(1)).alias("hits"), F.sum(log_discount("pos")).alias("dcg")))

    eligible = (recs.select(model_col, user_col).distinct()
                .join(n_truth, user_col)
                .withColumn("K", F.explode(k_arr)))

    m = eligible.join(hits, [model_col, user_col, "K"], "left").fillna(0, subset=["hits", "dcg"])
    return m.select(
        model_col, user_col, "K", "hits", "n_truth",
        (F.col("hits") / F.col("K")).alias("precision"),
        (F.col("hits") / F.col("n_truth")).alias("recall"),
        F.when(ideal_dcg(F.least(F.col("K"), F.col("n_truth"))) > 0,
               F.col("dcg") / ideal_dcg(F.least(F.col("K"), F.col("n_truth")))).otherwise(0.0).alias("ndcg"),
    )


def leaderboard(recs: DataFrame, truth: DataFrame, ks=DEFAULT_KS, model_col: str = "model",
                **kw) -> DataFrame:
    """Macro averages per (model, K): the evaluation table of the reference."""
    pu = per_user_metrics(recs, truth, ks, model_col=model_col, **kw)
    return (pu.groupBy(model_col, "K")
            .agg(r6(F.avg("precision")).alias("precision"),
                 r6(F.avg("recall")).alias("recall"),
                 r6(F.avg("ndcg")).alias("ndcg"),
                 F.count(F.lit(1)).alias("n_users_evaluated"))
            .withColumn("K", F.col("K").cast("int")))


def leaderboard_diff(board: DataFrame, base_model: str, other_model: str) -> DataFrame:
    """``other - base`` per K and metric (the comparison table printed by the reference)."""
    a = board.where(F.col("model") == base_model).select("K", *[F.col(m).alias(f"{m}_a")
                                                                for m in ("precision", "recall", "ndcg")])
    b = board.where(F.col("model") == other_model).select("K", *[F.col(m).alias(f"{m}_b")
                                                                 for m in ("precision", "recall", "ndcg")])
    return a.join(b, "K").select(
        "K", *[r6(F.col(f"{m}_b") - F.col(f"{m}_a")).alias(f"{m}_diff") for m in ("precision", "recall", "ndcg")])
