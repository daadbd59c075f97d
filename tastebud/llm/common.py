"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastebud.session import checkpoint_dir, materialize, ship_package

#: Characters that separate words: space and U+0009 to U+000D.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_SPLIT = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the maximal runs of non-separator characters; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS_SPLIT), "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body`` (a lambda over a column).

    A lambda variable is bound to the computed value, so an expensive
    expression (a split text) is not evaluated again for every use or element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor sees: a lost executor
    re-reads them.  Unlike ``checkpoint()`` the table keeps column pruning.
    """
    return materialize(df, tag=tag)


def prepare(spark) -> None:
    """Package on the Python workers, checkpoint folder known, Arrow batches bounded in bytes."""
    checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str = "left",
               max_broadcast_rows: int = 200_000, salts: int = 32) -> DataFrame:
    """Equi-join of a large ``left`` with a staged ``right`` of few, unique keys.

    ``right`` is counted: up to ``max_broadcast_rows`` it is broadcast; beyond
    that both sides get a salt (``right`` is repeated ``salts`` times), so that
    a key with a large share of ``left`` is spread over ``salts`` tasks.  Keys
    are compared null-safe; ``right``'s key columns are dropped.
    """
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = None
    for c in on:
        one = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        cond = one if cond is None else cond & one
    if right.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows:
        out = left.join(F.broadcast(r), cond, how)
    else:
        l = left.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        r = r.withColumn("__rsalt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        out = l.join(r, cond & (F.col("__salt") == F.col("__rsalt")), how).drop("__salt", "__rsalt")
    return out.drop(*[f"__r_{c}" for c in on])
