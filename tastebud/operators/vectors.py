"""Vector operators: standardisation, per-group mean vectors, normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.functions.numeric import l2_normalize


def standardize(df: DataFrame, feature_cols: list[str], keep_cols: list[str]) -> DataFrame:
    """Column-wise ``(x - mean) / std`` with the *population* std; constant column -> 0.0.

    The statistics are one global aggregate (exactly one row, map-side
    partial aggregation) read as a scalar subquery, so the data is never
    shuffled or joined.
    """
    stats = df.agg(F.struct(*[F.avg(c).alias(f"mu_{i}") for i, c in enumerate(feature_cols)],
                            *[F.stddev_pop(c).alias(f"sd_{i}") for i, c in enumerate(feature_cols)]).alias("_s"))
    st = stats.scalar()
    cols = []
    for i, c in enumerate(feature_cols):
        mu, sd = st.getField(f"mu_{i}"), st.getField(f"sd_{i}")
        cols.append(F.when(sd > 0, (F.col(c).cast("double") - mu) / sd).otherwise(F.lit(0.0)).alias(c))
    return df.select(*keep_cols, *cols)


def mean_vectors(df: DataFrame, group_col: str, vec_col: str, out_col: str = "profile") -> DataFrame:
    """Element-wise mean of an ``array<double>`` column per group.

    ``Summarizer.mean`` is a JVM aggregate with partial (map-side) merging: a
    group of any size is reduced in parallel before the shuffle.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return (df.groupBy(group_col)
            .agg(Summarizer.mean(array_to_vector(F.col(vec_col))).alias("_m"))
            .select(group_col, vector_to_array(F.col("_m")).alias(out_col)))


def mean_vectors_exploded(df: DataFrame, group_col: str, vec_col: str, out_col: str = "profile") -> DataFrame:
    """Same result via ``posexplode -> avg -> ordered collect`` (the SQL form)."""
    per_dim = (df.select(group_col, F.posexplode(vec_col).alias("_d", "_x"))
               .groupBy(group_col, "_d").agg(F.avg("_x").alias("_x")))
    return (per_dim.groupBy(group_col)
            .agg(F.array_sort(F.collect_list(F.struct("_d", "_x"))).alias("_s"))
            .select(group_col, F.transform("_s", lambda s: s["_x"]).alias(out_col)))


def normalize_vectors(df: DataFrame, vec_col: str = "vec", eps: float = 1e-8, out_col: str | None = None) -> DataFrame:
    """``v / (||v|| + eps)`` per row."""
    return df.withColumn(out_col or vec_col, l2_normalize(vec_col, eps))
