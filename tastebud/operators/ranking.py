"""Ranking primitives that stay correct and balanced when one key is huge.

``hashed_position`` numbers the rows of each group 1..n in the order of a
hash key.  A plain ``row_number() over (partition by group)`` sends a whole
group to one task; if a single user holds a third of all rows that task holds
a third of the data.  Here:

1. group sizes come from a partial (map-side combined) aggregation;
2. only *hot* groups (size > ``target_rows``) are kept, fewer than
   ``total_rows / target_rows`` of them; they are joined back without a hint, so
   the adaptive planner broadcasts the list only at its measured size;
3. a hot group's rows are split into ``ceil(n / target_rows)`` buckets by the
   leading bits of the (uniform) hash key — buckets are therefore ordered
   consistently with the key;
4. bucket offsets (a cumulative count over at most a few rows per hot group)
   are joined back in the same way;
5. positions are running counts per (group, bucket); equal rows (a repeated
   pair) are collapsed to one with a count first and spread out again after.

Ordinary groups have a single bucket, so their numbering and size come from
that same window.  Whether any hot group exists is decided first by one
small aggregate (the largest size); without one the plan is a single per-group
window — one shuffle of the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastebud.functions.hashing import unit_interval

DEFAULT_TARGET_ROWS = 2_000_000
#: Rows that a task sorts.  The planner goes by the exchanged bytes, which are few once the keys are left out.
SORT_ROWS = 1_000_000


def _sort_tasks(rows: int, parallelism: int) -> int:
    """Tasks of a sort: few enough rows each to be sorted in memory, and all cores where that pays."""
    return max(1, -(-rows // SORT_ROWS), min(parallelism, -(-rows // 65536)))


def long_ids(column) -> np.ndarray:
    """Ids of an Arrow column as 64-bit numbers; null is the smallest."""
    import pyarrow.compute as pc
    if column.null_count:
        column = pc.fill_null(column.cast("int64"), -2 ** 63)
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def whole_groups(batches, col: str, groups: int, size: int):
    """Rows sorted by ``col`` in tables of whole groups: about ``groups`` of them, fewer if they take ``size`` bytes."""
    import pyarrow as pa
    held, n, taken, last = [], 0, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = long_ids(batch.column(col))
        starts = np.flatnonzero(np.diff(ids)) + 1
        if last is None or ids[0] != last:
            starts = np.concatenate([[0], starts])
        if held and len(starts) and (n + len(starts) > groups or taken + batch.nbytes > size):
            cut = int(starts[-1])  # the last group may go on in the next batch
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            batch, starts = batch.slice(cut), [0]
            held, n, taken = [], 0, 0
        held.append(batch)
        n, taken, last = n + len(starts), taken + batch.nbytes, ids[-1]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _numbered(df: DataFrame, group_cols: list[str], w, pos_col: str, size_col: str) -> DataFrame:
    return (df.withColumn(pos_col, F.row_number().over(w).cast("long"))
            .withColumn(size_col, F.count(F.lit(1)).over(Window.partitionBy(*group_cols)).cast("long")))


def hashed_position(df: DataFrame, group_cols: list[str], key_col: str, tie_cols: list[str],
                    target_rows: int = DEFAULT_TARGET_ROWS, pos_col: str = "pos",
                    size_col: str = "n", key: Column | None = None) -> DataFrame:
    """Add ``pos`` (1-based rank by ``key_col, *tie_cols`` within the group) and ``n``.

    ``key_col`` must be an md5 hex string (see :func:`order_key`) so that its
    leading digits are uniform and order-consistent.  With ``key`` the column is
    not in ``df`` but computed from it, where it can be after the exchange, and
    left out of the result.
    """
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    hot = (sizes.where(F.col("_n") > F.lit(target_rows))
           .select(*group_cols, "_n", F.ceil(F.col("_n") / F.lit(float(target_rows))).cast("int").alias("_nb")))
    st = sizes.agg(F.max("_n").alias("most"), F.sum("_n").alias("rows")).first()
    if (st["most"] or 0) <= target_rows:
        # No hot group (the usual case): one window per group, one shuffle.
        w = Window.partitionBy(*group_cols).orderBy(key_col, *tie_cols)
        if key is not None:
            # rows are exchanged without their keys and sorted by the 16 bytes of them, which order as the digits do
            cols = [*df.columns, pos_col, size_col]
            parts = _sort_tasks(st["rows"] or 0, df.sparkSession.sparkContext.defaultParallelism)
            df = df.repartition(parts, *group_cols).withColumn(key_col, F.unhex(key))
            return _numbered(df, group_cols, w, pos_col, size_col).select(*cols)
        return _numbered(df, group_cols, w, pos_col, size_col)
    from tastebud.session import materialize
    if key is not None:
        cols = [*df.columns, pos_col, size_col]
        return hashed_position(df.withColumn(key_col, key), group_cols, key_col, tie_cols, target_rows, pos_col, size_col).select(*cols)
    hot = materialize(hot)
    # Copies of a row are one row with a count until they are numbered: a repeated pair is as light as any other.
    x = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_m")).join(hot, group_cols, "left")
    u = unit_interval(F.col(key_col))
    x = x.withColumn("_bucket", F.when(F.col("_nb").isNull(), F.lit(0))
                     .otherwise(F.least(F.floor(u * F.col("_nb")).cast("int"), F.col("_nb") - 1)))
    x = materialize(x)  # read by the offsets and the numbering
    offsets = (x.where(F.col("_nb").isNotNull())
               .groupBy(*group_cols, "_bucket").agg(F.sum("_m").alias("_bc"))
               .withColumn("_off", F.coalesce(F.sum("_bc").over(
                   Window.partitionBy(*group_cols).orderBy("_bucket")
                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .drop("_bc"))
    x = x.join(materialize(offsets), group_cols + ["_bucket"], "left")
    wall = Window.partitionBy(*group_cols, "_bucket")
    before = wall.orderBy(key_col, *tie_cols).rowsBetween(Window.unboundedPreceding, -1)
    x = (x.withColumn("_first", F.coalesce(F.col("_off"), F.lit(0)) + F.coalesce(F.sum("_m").over(before), F.lit(0)))
         .withColumn(size_col, F.coalesce(F.col("_n"), F.sum("_m").over(wall)).cast("long")))
    # the copies again, in runs, so that no row holds a long array
    run = 65536
    x = x.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1, F.lit(run).cast("long"))))
    x = x.withColumn("_i", F.explode(F.sequence("_from", F.least(F.col("_from") + run - 1, F.col("_m") - 1))))
    return (x.withColumn(pos_col, (F.col("_first") + F.col("_i") + 1).cast("long"))
            .select(*df.columns, pos_col, size_col))


def dedup_keep_first(df: DataFrame, key_cols: list[str], order_cols: list[str]) -> DataFrame:
    """``drop_duplicates(subset=key, keep='first')`` with an explicit order.

    Expressed as ``min_by`` over a struct — an aggregate with map-side partial
    combining, so a key with millions of copies never lands in one task whole.
    """
    others = [c for c in df.columns if c not in key_cols]
    if not order_cols or set(order_cols) <= set(key_cols):
        raise ValueError("keep-first needs an order column beside the key")
    order = F.struct(*[F.col(c) for c in order_cols])
    picked = df.groupBy(*key_cols).agg(F.min_by(F.struct(*[F.col(c) for c in others]), order).alias("_row"))
    return picked.select(*key_cols, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def dense_index(df: DataFrame, id_col: str, index_col: str = "idx", num_partitions: int | None = None) -> DataFrame:
    """Sorted distinct ids -> dense 0-based index (``id``, ``idx``).

    Range-partition the distinct ids, number them inside each partition with an
    Arrow batch function, then add per-partition offsets (one row per
    partition).  No driver collection of ids.
    """
    import pandas as pd

    ids = df.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    # Without an explicit count AQE may merge adjacent range partitions; they
    # stay disjoint and ordered, which is all the numbering needs.
    ranged = (ids.repartitionByRange(num_partitions, id_col) if num_partitions
              else ids.repartitionByRange(id_col)).sortWithinPartitions(id_col)
    id_type = df.schema[id_col].dataType.simpleString()

    # A partition is named by its smallest id (range partitions are disjoint and
    # ordered), not by the task's partition number, which shifts under unions.
    def number(batches):
        seen, first = 0, None
        for b in batches:
            m = len(b)
            if m == 0:
                continue
            if first is None:
                first = b[id_col].iloc[0]
            yield pd.DataFrame({id_col: b[id_col].values, "_part": first,
                                "_local": pd.RangeIndex(seen, seen + m).values})
            seen += m

    from tastebud.session import materialize
    # Written once: range bounds are sampled anew at every execution, so numbers
    # and offsets must come from the same one.
    local = materialize(ranged.mapInPandas(number, f"{id_col} {id_type}, _part {id_type}, _local long"))
    offsets = (local.groupBy("_part").agg(F.count(F.lit(1)).alias("_cnt"))
               .withColumn("_off", F.coalesce(F.sum("_cnt").over(
                   Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .drop("_cnt"))
    return (local.join(offsets, "_part")
            .select(id_col, (F.col("_off") + F.col("_local")).cast("long").alias(index_col)))
