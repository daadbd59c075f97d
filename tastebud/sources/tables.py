"""Bindings from the star-schema test tables to the recommender's concepts.

* raw items   <- ``part`` (id, name, a list-literal of "artists", popularity)
* features    <- ``part`` numbers + per-part aggregates of ``lineitem``
* interactions<- ``orders`` ⋈ ``lineitem``: (customer, part) pairs, play = 1.0
* item vectors<- ``embeddings`` (``vec_id = p_partkey``) restricted to ``part``

All readers select only the columns they need so the parquet scan prunes
columns, and filters stay above the scan where Catalyst can push them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Feature columns of the test binding, in matrix column order.
PART_FEATURES = ["popularity", "retail_price", "avg_quantity", "avg_discount", "avg_tax", "n_lines"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_state(spark: SparkSession, sf_dir: str, names: tuple) -> tuple:
    """Names, sizes and times of the tables' files: the key under which stage outputs are remembered.

    Asked of the store itself, so a table rewritten in the same place is a new input.
    """
    out = []
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        out.append((name, tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                                       for f in fs.listStatus(path)))))
    return tuple(out)


def interactions(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    """Implicit interactions ``(user_id, item_id, play=1.0)``.

    ``distinct=False`` keeps one row per line item (repeated pairs), the input
    for the duplicate-summing and overlap-repair operators.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    pairs = (lines.join(orders, lines.l_orderkey == orders.o_orderkey)
             .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id")))
    if distinct:
        pairs = pairs.distinct()
    return pairs.withColumn("play", F.lit(1.0))


def part_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-part aggregates of ``lineitem`` (partial aggregation before the shuffle)."""
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_partkey").alias("item_id"))
            .agg(F.avg("l_quantity").alias("avg_quantity"),
                 F.avg("l_discount").alias("avg_discount"),
                 F.avg("l_tax").alias("avg_tax"),
                 F.count(F.lit(1)).cast("double").alias("n_lines")))


def raw_items(spark: SparkSession, sf_dir: str, with_edge_cases: bool = False) -> DataFrame:
    """Raw item rows as the catalogue preparation expects them.

    ``artists`` is a Python list literal built from brand and type.  With
    ``with_edge_cases`` (the cleaning queries only) the input carries derived
    nulls and duplicates: ``name`` is null where
    ``p_partkey % 17 = 0`` and rows with ``p_partkey % 13 = 0`` appear a second
    time (``src_order = 1``, original name kept).  Nothing is dropped here.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                                               "p_retailprice")
    base = part.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("['"), F.col("p_brand"), F.lit("', '"), F.col("p_type"), F.lit("']")).alias("artists"),
        F.col("p_size").cast("double").alias("popularity"),
        F.col("p_retailprice").alias("retail_price"),
        F.lit(0).alias("src_order"),
    )
    if not with_edge_cases:
        return base
    originals = base.withColumn("name", F.when(F.col("item_id") % 17 == 0, F.lit(None).cast("string"))
                                .otherwise(F.col("name")))
    copies = base.where(F.col("item_id") % 13 == 0).withColumn("src_order", F.lit(1))
    return originals.unionByName(copies)


def raw_items_with_features(spark: SparkSession, sf_dir: str, with_edge_cases: bool = False) -> DataFrame:
    """Raw items plus the lineitem aggregates (left join: parts without lines get nulls)."""
    return raw_items(spark, sf_dir, with_edge_cases).join(part_line_stats(spark, sf_dir), "item_id", "left")


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, vec array<double>)`` for catalogue items that have an embedding."""
    part_ids = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"))
    emb = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("item_id"),
        F.col("embedding").cast("array<double>").alias("vec"))
    return emb.join(part_ids, "item_id", "left_semi")
