"""Set sizes by theta sketches and distributions by KLL sketches, stored by part and merged.

A sketch has a fixed size whatever the rows it saw, so a table of sketches by
day or other part answers for any set of parts without the rows; the exact
forms shuffle every key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Log2 of the entries of a theta sketch: 4096, a standard error of 1.6 % of a single set.
LG_ENTRIES = 12
#: Standard errors within which a theta estimate is promised.
SIGMAS = 5
#: Size parameter of a KLL sketch and the rank error promised for it (99 % limit of the sketch, doubled).
KLL_K = 400
OPS = ("union", "intersection", "only_a")


def kll_rank_error(k: int = KLL_K) -> float:
    return 2 * 2.446 / k ** 0.9433


# ------------------------------------------------------------------ set sizes
def set_sketches(members: DataFrame, by: tuple = ("set_name",), key: str = "key", lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``by, sketch``: a theta sketch of the keys of each set (null keys are in no set)."""
    return members.groupBy(*by).agg(F.theta_sketch_agg(key, F.lit(lg_entries)).alias("sketch"))


def merge_set_sketches(sketches: DataFrame, by: tuple = ("set_name",), lg_entries: int = LG_ENTRIES) -> DataFrame:
    """The sketches of all parts of a set as one."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("sketch", F.lit(lg_entries)).alias("sketch"))


def sketch_set_sizes(sketches: DataFrame, pairs: list[tuple[str, str]], lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``a, b, op, estimate, bound`` for the union, intersection and difference of each pair of sets.

    The standard error of a part of a union is that of a sample of ``2 ** lg_entries``
    keys of the union.  Pairs with a set that has no sketch are left out.
    """
    wanted = sketches.sparkSession.createDataFrame(pairs, "a string, b string")
    side = lambda c: sketches.select(F.col("set_name").alias(c), F.col("sketch").alias(f"_{c}"))
    both = wanted.join(side("a"), "a").join(side("b"), "b")
    size = lambda s: F.theta_sketch_estimate(s)
    whole = size(F.theta_union("_a", "_b", F.lit(lg_entries)))
    found = {"union": whole, "intersection": size(F.theta_intersection("_a", "_b")),
             "only_a": size(F.theta_difference("_a", "_b"))}
    rows = both.select("a", "b", whole.alias("_whole"), F.explode(F.array(*[
        F.struct(F.lit(op).alias("op"), found[op].alias("estimate")) for op in OPS])).alias("r"))
    k = float(1 << lg_entries)
    bound = SIGMAS * F.sqrt(F.col("_whole") * F.greatest(F.col("r.estimate").cast("double"), F.col("_whole") / k) / k)
    return rows.select("a", "b", "r.op", "r.estimate", bound.alias("bound"))


def exact_set_sizes(members: DataFrame, pairs: list[tuple[str, str]], key: str = "key") -> DataFrame:
    """``a, b, op, exact_size`` by one shuffle on the key; the sets named in ``pairs`` are few."""
    names = sorted({s for pair in pairs for s in pair})
    flags = members.where(F.col(key).isNotNull() & F.col("set_name").isin(names)).groupBy(key).agg(
        *[F.max(F.col("set_name") == F.lit(s)).alias(f"in_{i}") for i, s in enumerate(names)])
    where = {s: F.col(f"in_{i}") for i, s in enumerate(names)}
    cond = {"union": lambda a, b: a | b, "intersection": lambda a, b: a & b, "only_a": lambda a, b: a & ~b}
    wanted = [(a, b, op) for a, b in pairs for op in OPS]
    one = flags.agg(*[F.count_if(cond[op](where[a], where[b])).alias(f"n_{i}") for i, (a, b, op) in enumerate(wanted)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(op).alias("op"), F.col(f"n_{i}").alias("exact_size"))
        for i, (a, b, op) in enumerate(wanted)])).alias("r")).select("r.*")


# -------------------------------------------------------------- distributions
def count_sketches(counts: DataFrame, by: tuple, value: str, k: int = KLL_K) -> DataFrame:
    """``by, sketch``: a KLL sketch of the whole numbers ``value`` of each group."""
    return counts.groupBy(*by).agg(F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(k)).alias("sketch"))


def merge_count_sketches(sketches: DataFrame, by: tuple, k: int = KLL_K) -> DataFrame:
    return sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, quantiles: tuple = (0.1, 0.5, 0.9)) -> DataFrame:
    """The sketches' columns without the sketch, and ``quantile, n, value`` for each quantile.

    ``value`` may differ from run to run within the rank error: a KLL sketch flips coins.
    """
    keep = [c for c in sketches.columns if c != "sketch"]
    rows = F.explode(F.array(*[F.struct(
        F.lit(float(q)).alias("quantile"), F.kll_sketch_get_n_bigint("sketch").alias("n"),
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(q))).alias("value")) for q in quantiles])).alias("r")
    return sketches.select(*keep, rows).select(*keep, "r.*")


def rank_check(quantiles: DataFrame, counts: DataFrame, by: tuple, value: str, k: int = KLL_K) -> DataFrame:
    """``by, quantile, n, within``: whether a value's exact ranks come within the sketch's error of the quantile.

    The counts are reduced to their histogram before they meet the quantiles.
    """
    hist = counts.groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    n = lambda cond: F.sum(F.when(cond, F.col("_n")).otherwise(0))
    ranks = hist.join(quantiles, list(by)).groupBy(*by, "quantile", "n").agg(
        F.sum("_n").alias("_all"), n(F.col("_v") < F.col("value")).alias("_below"), n(F.col("_v") <= F.col("value")).alias("_upto"))
    eps = kll_rank_error(k)
    within = ((F.col("n") == F.col("_all")) & (F.col("_below") / F.col("_all") <= F.col("quantile") + eps)
              & (F.col("_upto") / F.col("_all") >= F.col("quantile") - eps))
    return ranks.select(*by, "quantile", "n", within.alias("within"))
