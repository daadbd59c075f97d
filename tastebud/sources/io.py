"""Readers, writers and schema checks for the pipeline's artefacts.

The reference exchanges CSV/NPY/JSON files between stages.  Here every
artefact is a DataFrame with an explicit schema; CSV stays available for
interchange, parquet is the default sink, and dense matrices become an
``array<double>`` column keyed by item id; ``.npy`` files and their alignment by
row position are in :mod:`tastebud.sources.npy`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def interactions_schema(user: T.DataType = T.LongType(), item: T.DataType = T.LongType()) -> T.StructType:
    """``user_id, item_id, play``; the id types are parameters, as item ids may be text."""
    return T.StructType([T.StructField("user_id", user), T.StructField("item_id", item),
                         T.StructField("play", T.DoubleType())])


def recs_schema(user: T.DataType = T.LongType(), item: T.DataType = T.LongType()) -> T.StructType:
    """``user_id, item_id, score, rank``."""
    return T.StructType([T.StructField("user_id", user), T.StructField("item_id", item),
                         T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> None:
    """Stop with a clear error when required columns are missing (schema only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; present: {df.columns}")


def column_check(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """``(column, present, n_rows, n_null)`` for every required column, in one pass over the present ones."""
    required = list(required)
    here = [c for c in required if c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_n{i}") for i, c in enumerate(here)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(c in here).alias("present"), F.col("_rows").alias("n_rows"),
                     (F.col("_rows") - F.col(f"_n{here.index(c)}") if c in here else F.lit(None).cast("long")).alias("n_null"))
            for c in required]
    return one.select(F.inline(F.array(*rows)))


_CORRUPT = "_corrupt_record"


def _checked_csv(spark: SparkSession, path: str, schema: T.StructType, ignore_extra: bool) -> DataFrame:
    """The cells as text by the names in the header, with file, values by type and a reason against each row (null: good)."""
    header = spark.read.option("header", "true").csv(path).columns
    missing = [c for c in schema.names if c not in header]
    extra = [c for c in header if c not in schema.names]
    if missing or (extra and not ignore_extra):
        raise ValueError(f"{path}: header {header}; missing columns {missing}, unknown columns {extra}")
    raw = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])
    # enforceSchema=false: a file whose header has another order stops the read
    cells = (spark.read.option("header", "true").option("mode", "PERMISSIVE").option("enforceSchema", "false")
             .option("columnNameOfCorruptRecord", _CORRUPT).schema(raw).csv(path)
             .select("*", F.col("_metadata.file_path").alias("_file")))
    typed = {c: F.col(c).try_cast(schema[c].dataType) for c in schema.names}
    bad = [F.when(F.col(c).isNotNull() & typed[c].isNull(), F.concat_ws(": ", F.lit(c), F.col(c))) for c in schema.names]
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit("malformed record")).otherwise(F.nullif(F.concat_ws("; ", *bad), F.lit("")))
    record = F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*[F.col(c) for c in header])))
    return cells.select(*[typed[c].alias(c) for c in schema.names], F.col("_file"), reason.alias("_reason"), record.alias("_record"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, ignore_extra: bool = False) -> DataFrame:
    """CSV with header.

    With a schema the columns are found by the header's names, whatever their
    order; a header that lacks one or (without ``ignore_extra``) has others is
    refused, and so are files whose headers differ.  A cell that is not of its
    type, or a row of too few or too many cells, stops the read with its reason
    (:func:`read_csv_quarantined` keeps such rows apart).  Without a schema the
    types are inferred, which takes another pass.
    """
    if schema is None:
        return spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    rows = _checked_csv(spark, path, schema, ignore_extra)
    complaint = F.concat(F.col("_file"), F.lit(": "), F.col("_reason"), F.lit(" in "), F.coalesce("_record", F.lit("")))
    refused = F.when(F.col("_reason").isNotNull(), F.raise_error(complaint).cast("boolean")).otherwise(F.lit(True))
    return rows.where(refused).select(*schema.names)


def read_csv_quarantined(spark: SparkSession, path: str, schema: T.StructType,
                         ignore_extra: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(good rows, (file, reason, record) of the others)``; headers as in :func:`read_csv`.

    ``record`` is the cells as JSON, or the line of a malformed row.
    """
    rows = _checked_csv(spark, path, schema, ignore_extra)
    good = rows.where(F.col("_reason").isNull()).select(*schema.names)
    bad = rows.where(F.col("_reason").isNotNull())
    return good, bad.select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.col("_record").alias("record"))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, no index column, overwrite."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json_record(df: DataFrame, path: str) -> None:
    """One-record JSON artefacts (feature list, model info)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def vectors_to_array(df: DataFrame, feature_cols: list[str], id_col: str = "item_id",
                     out_col: str = "features") -> DataFrame:
    """Dense feature matrix as ``(id, array<double>)`` keyed by id."""
    return df.select(id_col, F.array(*[F.col(c).cast("double") for c in feature_cols]).alias(out_col))
