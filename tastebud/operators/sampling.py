"""Reproducible sampling operators (re-aimed from the interaction simulator).

All randomness is an md5 of ``seed:key...`` (see ``functions.hashing``), so
samples are identical across runs, partitionings and engines.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastebud.functions.hashing import open_unit_interval, order_key
from tastebud.operators.ranking import DEFAULT_TARGET_ROWS, hashed_position


def sample_per_group(df: DataFrame, group_cols: list[str], n: int, item_col: str, seed: int = 42,
                     target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """``n`` rows per group without replacement (all rows when fewer), ``sample_pos`` 1..n."""
    keyed = df.withColumn("_key", order_key(seed, *group_cols, item_col))
    ranked = hashed_position(keyed, group_cols, "_key", [item_col], target_rows=target_rows,
                             pos_col="sample_pos", size_col="_gn")
    return ranked.where(F.col("sample_pos") <= F.lit(n)).drop("_key", "_gn")


def prefix_sums(df: DataFrame, order_col: str, value_col: str, out_col: str = "cum",
                num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value_col`` in ``order_col`` order (distinct keys).

    Range-partitioned, summed inside each partition by an Arrow batch
    function, then shifted by per-partition totals (one row per partition,
    broadcast).  No global single-partition window.
    """
    import numpy as np

    ranged = (df.repartitionByRange(num_partitions, order_col) if num_partitions
              else df.repartitionByRange(order_col)).sortWithinPartitions(order_col)
    schema = df.schema.simpleString()[len("struct<"):-1].replace(":", " ")

    key_type = df.schema[order_col].dataType.simpleString()

    # Partitions are named by their first key (see ``dense_index``).
    def local(batches):
        run, first = 0.0, None
        for b in batches:
            if len(b) == 0:
                continue
            if first is None:
                first = b[order_col].iloc[0]
            c = np.cumsum(b[value_col].to_numpy(dtype=np.float64)) + run
            run = float(c[-1])
            yield b.assign(_part=first, _local=c)

    from tastebud.session import materialize
    # Written once: range bounds are sampled anew at every execution.
    loc = materialize(ranged.mapInPandas(local, f"{schema}, _part {key_type}, _local double"))
    totals = (loc.groupBy("_part").agg(F.max("_local").alias("_t"))
              .withColumn("_off", F.coalesce(F.sum("_t").over(
                  Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .drop("_t"))
    return (loc.join(totals, "_part")
            .withColumn(out_col, F.col("_off") + F.col("_local")).drop("_part", "_local", "_off"))


def weighted_group_pick(users: DataFrame, groups: DataFrame, user_col: str = "user_id",
                        group_col: str = "group", weight_col: str = "n", seed: int = 42,
                        n_bins: int | None = None, min_weight: float = 0.0) -> DataFrame:
    """One group per user, drawn with probability proportional to the group's weight.

    Groups below ``min_weight`` (the support rule) are left out first.

    Inverse-CDF draw: every user gets ``u = md5(seed:user)`` in (0, 1); the
    groups' cumulative shares form intervals ``[lo, hi)``; the pick is the
    interval containing ``u``.  That range join is made an equi-join by
    cutting [0, 1) into ``n_bins`` bins: each interval is listed under every
    bin it overlaps (groups + bins rows in total), each user under its one bin.

    With ``n_bins >= 4 * groups`` (the default) a user meets on average at most
    ``1 + groups / n_bins <= 1.25`` intervals, however the weights cluster: the
    interval starts sum to ``groups`` over all bins and users are uniform in u.
    """
    g = groups.select(group_col, F.col(weight_col).cast("double").alias("_w")).where((F.col("_w") > 0) & (F.col("_w") >= F.lit(float(min_weight))))
    if n_bins is None:
        n_bins = max(1024, 4 * g.count())
    cum = prefix_sums(g, group_col, "_w", "_hi_abs")
    total = g.agg(F.sum("_w").alias("_total")).scalar()
    iv = cum.select(group_col, ((F.col("_hi_abs") - F.col("_w")) / total).alias("_lo"),
                    (F.col("_hi_abs") / total).alias("_hi"))
    # A heavy group overlaps many bins: its bins are listed in runs of up to 1024, so no row holds a long array.
    first = F.floor(F.col("_lo") * n_bins).cast("int")
    last = F.least(F.floor(F.col("_hi") * n_bins).cast("int"), F.lit(n_bins - 1))
    iv = iv.withColumn("_first", first).withColumn("_last", last)
    iv = iv.withColumn("_from", F.explode(F.sequence("_first", "_last", F.lit(1024))))
    iv = iv.repartition("_from").withColumn("_bin", F.explode(F.sequence("_from", F.least(F.col("_from") + 1023, "_last"))))
    u = users.select(user_col).distinct().withColumn(
        "_u", open_unit_interval(order_key(seed, user_col)))
    u = u.withColumn("_bin", F.floor(F.col("_u") * n_bins).cast("int"))
    return (u.join(iv, "_bin")
            .where((F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi")))
            .select(user_col, F.col(group_col).alias("picked_group")))


def next_prime(n: int) -> int:
    """Smallest prime >= n (n is a catalogue size: a driver-side number)."""
    def is_prime(m):
        if m < 2:
            return False
        if m % 2 == 0:
            return m == 2
        r = int(math.isqrt(m))
        return all(m % d for d in range(3, r + 1, 2))
    m = max(2, n)
    while not is_prime(m):
        m += 1
    return m


def negative_samples(inter: DataFrame, catalog_index: DataFrame, n: int, seed: int = 42,
                     user_col: str = "user_id", item_col: str = "item_id", idx_col: str = "idx",
                     chunk: int = 4096) -> DataFrame:
    """``n`` catalogue items per user that the user does not own (all if fewer).

    Each user walks the catalogue in a user-specific pseudo-random order: an
    affine permutation ``j -> (a*j + b) mod P`` over the smallest prime
    ``P >= N`` (positions ``>= N`` skipped).  Only the first
    ``n + owned + (P - N)`` positions are generated, which always leaves ``n``
    unowned candidates when they exist — no user x item product.  Positions
    are generated in chunks so a very active user spreads over many tasks.
    Output ``(user_id, item_id, neg_pos)``.
    """
    from tastebud.session import materialize
    catalog_index = materialize(catalog_index.select(item_col, idx_col))
    owned = materialize(inter.select(user_col, item_col).distinct())
    owned_idx = owned.join(catalog_index.select(item_col, idx_col), item_col)
    N = catalog_index.count()
    P = next_prime(N)
    per_user = owned.groupBy(user_col).agg(F.count(F.lit(1)).alias("_own"))
    key = order_key(seed, user_col)
    a = F.lit(1) + F.pmod(F.conv(F.substring(key, 1, 12), 16, 10).cast("long"), F.lit(P - 1))
    b = F.pmod(F.conv(F.substring(key, 13, 12), 16, 10).cast("long"), F.lit(P))
    m = F.least(F.col("_own") + F.lit(n + (P - N)), F.lit(P)).cast("long")
    plan = per_user.select(user_col, a.alias("_a"), b.alias("_b"), m.alias("_m"))
    chunks = (plan.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"),
                                                         F.floor((F.col("_m") - 1) / chunk).cast("long"))))
              .repartition(user_col, "_c"))
    pos = chunks.withColumn("_j", F.explode(F.sequence(
        F.col("_c") * chunk, F.least(F.col("_c") * chunk + chunk - 1, F.col("_m") - 1))))
    pos = pos.withColumn(idx_col, F.pmod(F.col("_a") * F.col("_j") + F.col("_b"), F.lit(P))).where(
        F.col(idx_col) < F.lit(N))
    cand = (pos.join(owned_idx.select(user_col, idx_col), [user_col, idx_col], "left_anti")
            .select(user_col, "_c", idx_col, "_j"))
    # Chunks needed to reach n candidates: running counts over (user, chunk) — a
    # table with one row per chunk — then numbering within (user, chunk) only.
    per_chunk = (cand.groupBy(user_col, "_c").agg(F.count(F.lit(1)).alias("_cc"))
                 .withColumn("_before", F.coalesce(F.sum("_cc").over(
                     Window.partitionBy(user_col).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)),
                     F.lit(0)))
                 .where(F.col("_before") < F.lit(n)).select(user_col, "_c", "_before"))
    w = Window.partitionBy(user_col, "_c").orderBy("_j")
    top = (cand.join(per_chunk, [user_col, "_c"])
           .withColumn("neg_pos", F.col("_before") + F.row_number().over(w))
           .where(F.col("neg_pos") <= F.lit(n)))
    return top.join(catalog_index.select(item_col, idx_col), idx_col).select(user_col, item_col, "neg_pos")
