"""Item catalogue preparation.

Steps run in the reference's order, which matters (dedup happens before the
drop of incomplete rows; the support count happens before the popularity
cut):

1. main artist parsed from a list literal; rows without one dropped
2. known feature columns that exist are selected (missing ones reported)
3. duplicates on id dropped, keeping the first by an explicit order column
4. rows with a null/NaN id, name, artist or feature dropped
5. artists with fewer than ``min_support`` items dropped
6. ``popularity >= min_popularity`` when that column exists
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.functions.numeric import r6
from tastebud.functions.text import main_artist
from tastebud.operators.ranking import dedup_keep_first
from tastebud.operators.vectors import standardize
from tastebud.session import materialize
from tastebud.sources.io import require_columns

# The audio feature names the reference looks for, in matrix order
# (popularity is appended when present).
REFERENCE_FEATURES = ["danceability", "energy", "valence", "acousticness", "instrumentalness",
                      "liveness", "speechiness", "tempo", "loudness", "duration_ms"]


@dataclass
class CatalogSpec:
    feature_cols: list
    id_col: str = "item_id"
    name_col: str = "name"
    artists_col: str = "artists"
    order_col: str | None = "src_order"
    popularity_col: str = "popularity"
    year_col: str = "year"
    min_support: int = 20
    min_popularity: float | None = 55.0


def available_features(df: DataFrame, wanted: list[str]) -> tuple[list[str], list[str]]:
    """``(present, missing)`` feature names, order kept (schema only, no job)."""
    return [c for c in wanted if c in df.columns], [c for c in wanted if c not in df.columns]


def with_artist(df: DataFrame, spec: CatalogSpec) -> DataFrame:
    return df.withColumn("artist", main_artist(spec.artists_col))


def missing_features(df: DataFrame, wanted: list[str]) -> DataFrame:
    """``(feature, present)`` for every wanted feature column, in order (a report; schema only)."""
    present, _ = available_features(df, wanted)
    return df.sparkSession.createDataFrame([(c, c in present) for c in wanted], "feature string, present boolean")


def _stages(raw: DataFrame, spec: CatalogSpec) -> list[tuple[str, DataFrame]]:
    require_columns(raw, [spec.id_col, spec.name_col, spec.artists_col, *([spec.order_col] if spec.order_col else [])],
                    "raw items")
    feats, _ = available_features(raw, spec.feature_cols)
    s1 = with_artist(raw, spec).where(F.col("artist").isNotNull())
    s2 = dedup_keep_first(s1, [spec.id_col], [spec.order_col] if spec.order_col else [])
    s3 = s2.na.drop("any", subset=[spec.id_col, spec.name_col, "artist"] + feats)
    s4 = min_support_filter(s3, "artist", spec.min_support)
    s5 = s4
    if spec.min_popularity is not None and spec.popularity_col in raw.columns:
        s5 = s4.where(F.col(spec.popularity_col) >= F.lit(spec.min_popularity))
    return [("parsed_artist", s1), ("deduplicated", s2), ("complete_rows", s3),
            ("artist_support", s4), ("popularity", s5)]


def min_support_filter(df: DataFrame, group_col: str, min_support: int) -> DataFrame:
    """Keep rows whose group has at least ``min_support`` rows (null groups dropped).

    The counts come from a partial aggregation; the surviving groups are
    semi-joined back (AQE broadcasts them when small and splits a hot group's
    partition otherwise).
    """
    keep = (df.where(F.col(group_col).isNotNull()).groupBy(group_col)
            .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= F.lit(min_support)).select(group_col))
    return df.join(keep, group_col, "left_semi")


def prepare_catalog(raw: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Cleaned catalogue: id, name, artist, year?, popularity?, features."""
    feats, _ = available_features(raw, spec.feature_cols)
    final = _stages(raw, spec)[-1][1]
    meta = [spec.id_col, spec.name_col, "artist"] + [c for c in (spec.year_col, spec.popularity_col)
                                                      if c in raw.columns]
    return final.select(*meta, *[c for c in feats if c not in meta])


def catalog_funnel(raw: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Rows before/after each cleaning step: ``(step_no, step, rows_in, rows_out, removed)``.

    The raw rows are read once (with the parsed artist) and the deduplicated
    rows are a stage output; the later steps are conditional counts over it.
    """
    feats, _ = available_features(raw, spec.feature_cols)
    need = [spec.id_col, spec.name_col, "artist", *feats]
    base = materialize(with_artist(raw, spec))
    s2 = dedup_keep_first(base.where(F.col("artist").isNotNull()), [spec.id_col], [spec.order_col] if spec.order_col else [])
    kinds = dict(base.dtypes)
    whole = F.lit(True)
    for c in need:
        ok = F.col(c).isNotNull()
        whole = whole & (ok & ~F.isnan(c) if kinds[c] in ("double", "float") else ok)
    s2 = materialize(s2.select("artist", whole.alias("_whole"), *(
        [spec.popularity_col] if spec.popularity_col in raw.columns else [])))
    support = s2.where("_whole").groupBy("artist").agg(F.count(F.lit(1)).alias("_n")).where(
        F.col("_n") >= F.lit(spec.min_support))
    j = s2.join(support, "artist", "left")
    kept = F.col("_whole") & F.col("_n").isNotNull()
    popular = kept
    if spec.min_popularity is not None and spec.popularity_col in raw.columns:
        popular = kept & (F.col(spec.popularity_col) >= F.lit(spec.min_popularity))
    first = base.agg(F.count(F.lit(1)).alias("c0"), F.count("artist").alias("c1"))
    rest = j.agg(F.count(F.lit(1)).alias("c2"), F.count(F.when(F.col("_whole"), 1)).alias("c3"),
                 F.count(F.when(kept, 1)).alias("c4"), F.count(F.when(popular, 1)).alias("c5"))
    from tastebud.operators.diagnostics import one_row
    one = one_row(first, rest)
    names = ["input", "parsed_artist", "deduplicated", "complete_rows", "artist_support", "popularity"]
    steps = F.array(*[F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"),
                               F.col(f"c{max(i - 1, 0)}").alias("rows_in"), F.col(f"c{i}").alias("rows_out"),
                               (F.col(f"c{max(i - 1, 0)}") - F.col(f"c{i}")).alias("removed"))
                      for i, n in enumerate(names)])
    return one.select(F.explode(steps).alias("s")).select("s.*")


def standardized_features(catalog: DataFrame, feature_cols: list[str], id_col: str = "item_id") -> DataFrame:
    """Standard scores of the catalogue features (population std; constant -> 0)."""
    return standardize(catalog, feature_cols, [id_col])


def standardization_check(std: DataFrame, feature_cols: list[str]) -> DataFrame:
    """Global mean and (population) std over all cells of the standardised matrix."""
    cells = std.select(F.explode(F.array(*[F.col(c) for c in feature_cols])).alias("x"))
    return cells.agg(r6(F.avg("x")).alias("mean"), r6(F.stddev_pop("x")).alias("std"),
                     F.count(F.lit(1)).alias("n_cells"))
