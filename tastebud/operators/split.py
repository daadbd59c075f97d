"""Per-user train/test split (positional cut after a deterministic shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.functions.hashing import order_key
from tastebud.operators.ranking import DEFAULT_TARGET_ROWS, hashed_position
from tastebud.sources.io import require_columns

DEFAULT_SEED = 42
DEFAULT_TRAIN_RATIO = 0.8
DEFAULT_MIN_INTERACTIONS = 2


def n_train_expr(n, train_ratio: float = DEFAULT_TRAIN_RATIO):
    """``max(1, int(n * ratio))``, moved down by one when no test row would remain."""
    n = F.col(n) if isinstance(n, str) else n
    base = F.greatest(F.lit(1).cast("long"), F.floor(n.cast("double") * F.lit(float(train_ratio))).cast("long"))
    return F.when((n - base == 0) & (n > 1), n - 1).otherwise(base)


def assign_split(interactions: DataFrame, seed: int = DEFAULT_SEED, train_ratio: float = DEFAULT_TRAIN_RATIO,
                 min_interactions: int = DEFAULT_MIN_INTERACTIONS, user_col: str = "user_id",
                 item_col: str = "item_id", target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """All rows of users with at least ``min_interactions`` rows, tagged.

    Adds ``pos`` (1-based place in the user's shuffled list), ``n`` (the
    user's row count), ``n_train`` and ``is_train``.  The shuffle order is
    ``md5(seed:user:item)`` then item id, identical in any engine.
    """
    require_columns(interactions, [user_col, item_col], "interactions")
    ranked = hashed_position(interactions, [user_col], "_key", [item_col], target_rows=target_rows,
                             key=order_key(seed, user_col, item_col))
    return (ranked.where(F.col("n") >= F.lit(min_interactions))
            .withColumn("n_train", n_train_expr("n", train_ratio))
            .withColumn("is_train", F.col("pos") <= F.col("n_train")))


def split_train_test(interactions: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with the input columns plus ``pos``."""
    tagged = assign_split(interactions, **kw)
    cols = interactions.columns + ["pos"]
    return tagged.where("is_train").select(*cols), tagged.where("NOT is_train").select(*cols)


def excluded_users(interactions: DataFrame, min_interactions: int = DEFAULT_MIN_INTERACTIONS,
                   user_col: str = "user_id") -> DataFrame:
    """Users left out of the split for having fewer than ``min_interactions`` rows."""
    return (interactions.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_interactions"))
            .where(F.col("n_interactions") < F.lit(min_interactions)))


def remove_test_overlap(train: DataFrame, test: DataFrame, user_col: str = "user_id",
                        item_col: str = "item_id") -> DataFrame:
    """Drop test rows whose (user, item) also occurs in train (train wins)."""
    keys = train.select(user_col, item_col).distinct()
    return test.join(keys, [user_col, item_col], "left_anti")
