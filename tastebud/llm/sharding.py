"""Sharding by a two-pass external shuffle.

Pass one scatters the rows by a seeded hash into buckets that fit in memory;
pass two shuffles each bucket (Fisher-Yates) and writes it.  The buckets in
order are one random permutation of the table, which is cut into shards whose
row counts differ by at most one (law ``rows``).
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastebud.llm.common import join_small, staged
from tastebud.session import checkpoint_dir

N_SHARDS = 24
BUCKET_BYTES = 32 << 20
MIN_BUCKETS = 48


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def shard_of(pos: Column, n: Column, shards: int) -> tuple[Column, Column]:
    """``(shard, slot)`` of a position: the first ``n % shards`` shards have one row more."""
    q = F.floor(n / shards)
    r = n % shards
    cut = r * (q + 1)
    shard = F.when(pos < cut, F.floor(pos / (q + 1))).otherwise(r + F.floor((pos - cut) / F.greatest(q, F.lit(1))))
    start = shard * q + F.least(shard, r)
    return shard.cast("int"), (pos - start).cast("long")


def bucket_of(doc_id: Column, text: Column, seed: int, buckets: int) -> Column:
    """Bucket of a row, by id and text: only rows that share both share it for certain."""
    return F.pmod(F.xxhash64(F.lit(seed), doc_id, text), F.lit(buckets)).cast("int")


def write_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = N_SHARDS,
                 seed: int = 42, bucket_bytes: int = BUCKET_BYTES, path: str | None = None) -> DataFrame:
    """Write the shuffled rows under ``path`` (default: the shared folder), one folder per shard; returns the table.

    Columns: ``row`` (the whole input row), ``slot`` (its place in the shard,
    gapless from 0), ``shard``.  The bucket is a hash of id and text, so reruns
    agree and rows of one id are spread.  A bucket's rows stream past their
    permutation (8 bytes a row) and Spark's sorts spill, so even a bucket of
    many copies of a row stays within memory.  Null ids and null texts are rows like any other; repeated
    rows are kept; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    size = docs.agg(F.sum(row_bytes(F.col(text_col))).alias("b"), F.count(F.lit(1)).alias("n")).first()
    buckets = max(MIN_BUCKETS, -(-(size["b"] or 0) // bucket_bytes))
    bucket = bucket_of(F.col(id_col), F.col(text_col), seed, buckets)

    counts = docs.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    counts = staged(counts.select("bucket", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base")),
                    "buckets")

    src = join_small(docs.select(F.struct("*").alias("row"), bucket.alias("bucket")), counts, ["bucket"], "inner")
    order = ["bucket", F.xxhash64(F.col(f"row.{id_col}")), F.xxhash64(F.col(f"row.{text_col}")),
             F.octet_length(F.col(f"row.{text_col}"))]
    src = src.repartitionById(buckets, F.col("bucket")).sortWithinPartitions(*order)  # a task for every bucket

    def fisher_yates(batches):
        now, perm, i = None, None, 0
        for batch in batches:
            b, rows, base = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "rows", "base"))
            pos = np.empty(len(b), np.int64)
            cuts = np.r_[0, np.flatnonzero(np.diff(b)) + 1, len(b)]
            for a, z in zip(cuts[:-1], cuts[1:]):
                if z == a:
                    continue
                if b[a] != now:
                    now, i = b[a], 0
                    perm = np.random.default_rng([seed, int(now)]).permutation(int(rows[a]))
                pos[a:z] = base[a] + perm[i:i + z - a]
                i += z - a
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(pos)], names=["row", "pos"])

    placed = src.mapInArrow(fisher_yates, T.StructType([src.schema["row"], T.StructField("pos", T.LongType())]))
    shard, slot = shard_of(F.col("pos"), F.lit(size["n"]), shards)
    placed = placed.select("row", slot.alias("slot"), shard.alias("shard")).sortWithinPartitions("shard", "slot")
    placed.write.partitionBy("shard").parquet(path)
    schema = T.StructType([placed.schema["row"], placed.schema["slot"], placed.schema["shard"]])
    return spark.read.schema(schema).parquet(path)
