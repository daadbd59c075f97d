"""The recommender pipeline bound to the test tables, stage by stage.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the
registered queries compose them.  Parameters follow the reference's code
defaults except where the test binding needs its own value (documented).
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastebud.operators.by_user import UserFacts, user_facts
from tastebud.operators.content import content_recommend, with_model
from tastebud.operators.evaluation import DEFAULT_KS, compact_ranks, leaderboard
from tastebud.operators.reports import lookup_table
from tastebud.operators.split import assign_split
from tastebud.session import materialize, release_stages
from tastebud.sources import tables


@dataclass(frozen=True)
class Params:
    seed: int = 42
    train_ratio: float = 0.8
    min_interactions: int = 2
    # Registered queries recommend K = 20 (= the largest metric K); the
    # library default of the reference is 500.
    k: int = 20
    ks: tuple = DEFAULT_KS
    min_support: int = 20
    # p_size runs 1..50 where the reference's popularity runs 0..100.
    min_popularity: float = 25.0
    als_rank: int = 16
    als_iter: int = 5
    als_reg: float = 0.01
    als_alpha: float = 1.0
    extra: dict = field(default_factory=dict)


P = Params()


_INTER, _ITEMS, _VECS = ("orders", "lineitem"), ("part", "lineitem"), ("embeddings", "part")
_MEMO: dict = {}


def _stage(spark: SparkSession, sf_dir: str, kind: str, tables_read: tuple, p, build) -> DataFrame:
    """A stage output, written once per session, state of the input tables and parameters."""
    key = (spark.sparkContext.applicationId, kind, sf_dir, tables.input_state(spark, sf_dir, tables_read), repr(p))
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def clear_stage_outputs(spark: SparkSession | None = None) -> None:
    """Forget memoised stage outputs (benchmarks start every query from the tables); with ``spark`` also delete them."""
    _MEMO.clear()
    if spark is not None:
        release_stages(spark)


def interaction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All distinct interactions as a stage output: the split reads them twice, its statistics once more."""
    return _stage(spark, sf_dir, "pairs", _INTER, None,
                  lambda: materialize(tables.interactions(spark, sf_dir).drop("play"))).withColumn("play", F.lit(1.0))


def split_tagged(spark: SparkSession, sf_dir: str, p: Params = P, materialized: bool = False) -> DataFrame:
    """The per-user split of all interactions (``is_train``, ``pos``, ``n``).

    ``materialized=True`` returns the stage output, written once with train and
    test apart: the counterpart of the reference's train/test files.
    """
    def split():
        return assign_split(interaction_pairs(spark, sf_dir), seed=p.seed, train_ratio=p.train_ratio,
                            min_interactions=p.min_interactions)
    if not materialized:
        return split()
    return _stage(spark, sf_dir, "split", _INTER, p, lambda: materialize(split(), ("is_train",)))


def train_set(spark: SparkSession, sf_dir: str, p: Params = P, materialized: bool = False) -> DataFrame:
    return split_tagged(spark, sf_dir, p, materialized).where("is_train").select("user_id", "item_id", "play", "pos")


def test_set(spark: SparkSession, sf_dir: str, p: Params = P, materialized: bool = False) -> DataFrame:
    return (split_tagged(spark, sf_dir, p, materialized).where("NOT is_train")
            .select("user_id", "item_id", "play", "pos"))


def content_recs(spark: SparkSession, sf_dir: str, p: Params = P, k: int | None = None,
                 materialized: bool = True) -> DataFrame:
    return content_recommend(train_set(spark, sf_dir, p, materialized), tables.item_vectors(spark, sf_dir),
                             k or p.k)


def content_leaderboard(spark: SparkSession, sf_dir: str, p: Params = P) -> DataFrame:
    recs = compact_ranks(with_model(content_recs(spark, sf_dir, p), "content"))
    return leaderboard(recs, test_set(spark, sf_dir, p, True), p.ks)


def model_recs(recs: DataFrame, name: str) -> DataFrame:
    return with_model(recs, name).select("model", "user_id", "item_id", F.col("score"), F.col("rank"))


# ------------------------------------------------------------- catalogue
from tastebud.operators.catalog import CatalogSpec, prepare_catalog  # noqa: E402


def catalog_spec(p: Params = P, **over) -> CatalogSpec:
    kw = dict(feature_cols=list(tables.PART_FEATURES), min_support=p.min_support,
              min_popularity=p.min_popularity)
    kw.update(over)
    return CatalogSpec(**kw)


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.raw_items_with_features(spark, sf_dir)


def catalog(spark: SparkSession, sf_dir: str, p: Params = P, materialized: bool = False) -> DataFrame:
    """The prepared catalogue; ``materialized=True`` returns the stage output
    (the counterpart of the reference's metadata + feature files)."""
    def prepare():
        return prepare_catalog(raw_items(spark, sf_dir), catalog_spec(p))
    return _stage(spark, sf_dir, "catalog", _ITEMS, p, lambda: materialize(prepare())) if materialized else prepare()


# ---------------------------------------------------------------- models
from tastebud.operators import als as ALS  # noqa: E402
from tastebud.operators import autoencoder as AE  # noqa: E402
from tastebud.operators.catalog import standardized_features  # noqa: E402
from tastebud.sources.io import vectors_to_array  # noqa: E402


def catalog_train(spark: SparkSession, sf_dir: str, p: Params = P) -> DataFrame:
    """The training rows whose item is in the prepared catalogue: what the collaborative model learns from."""
    return train_set(spark, sf_dir, p, True).join(catalog(spark, sf_dir, p, True).select("item_id"), "item_id", "left_semi")


def als_fit(spark: SparkSession, sf_dir: str, p: Params = P) -> ALS.AlsFit:
    return ALS.fit_als(catalog_train(spark, sf_dir, p), rank=p.als_rank, max_iter=p.als_iter, reg=p.als_reg,
                       alpha=p.als_alpha, seed=p.seed)


def als_recs(spark: SparkSession, sf_dir: str, p: Params = P, k: int | None = None) -> DataFrame:
    return ALS.als_recommend(als_fit(spark, sf_dir, p), catalog_train(spark, sf_dir, p), k or p.k)


def catalog_vectors(spark: SparkSession, sf_dir: str, p: Params = P) -> DataFrame:
    """Standardised catalogue features as ``(item_id, vec)``."""
    feats = list(tables.PART_FEATURES)
    return vectors_to_array(standardized_features(catalog(spark, sf_dir, p, True), feats), feats, out_col="vec")


@dataclass
class AeFit:
    data: DataFrame       # item_id, vec: the training input
    params: AE.AeParams
    losses: list          # by epoch
    seconds: float


def ae_fit(spark: SparkSession, sf_dir: str, p: Params = P) -> AeFit:
    """The autoencoder trained on the catalogue with the library's epochs and steps, once for all queries that use it."""
    def build():
        t0 = time.time()
        data = AE.training_input(catalog_vectors(spark, sf_dir, p), "item_id", "vec")
        params, losses = AE.train(data, len(tables.PART_FEATURES), seed=p.seed)
        return AeFit(data, params, losses, time.time() - t0)
    return _stage(spark, sf_dir, "autoencoder", _ITEMS, p, build)


def ae_recs(spark: SparkSession, sf_dir: str, p: Params = P, k: int | None = None) -> DataFrame:
    fit = ae_fit(spark, sf_dir, p)
    return content_recommend(train_set(spark, sf_dir, p, True), AE.encode(fit.data, fit.params), k or p.k,
                             materialize_items=True)


def ae_fixed_vectors(spark: SparkSession, sf_dir: str, p: Params = P) -> DataFrame:
    """Catalogue items encoded by the fixed closed-form autoencoder weights."""
    return AE.encode(catalog_vectors(spark, sf_dir, p), AE.formula_params(len(tables.PART_FEATURES)))


def ae_fixed_recs(spark: SparkSession, sf_dir: str, p: Params = P, k: int | None = None) -> DataFrame:
    return content_recommend(train_set(spark, sf_dir, p, True), ae_fixed_vectors(spark, sf_dir, p), k or p.k,
                             materialize_items=True)


def two_model_recs(spark: SparkSession, sf_dir: str, p: Params = P) -> DataFrame:
    """Recs of both deterministic models: ``content`` and ``autoencoder`` (fixed weights).

    A stage output (the counterpart of the reference's recommendation files),
    shared by the evaluation, diagnostics and report queries.
    """
    def build():
        return materialize(model_recs(content_recs(spark, sf_dir, p), "content")
                           .unionByName(model_recs(ae_fixed_recs(spark, sf_dir, p), "autoencoder")))
    return _stage(spark, sf_dir, "recs", tuple(sorted({*_INTER, *_ITEMS, *_VECS})), p, build)


def recs_lookup(spark: SparkSession, sf_dir: str, p: Params = P) -> DataFrame:
    """:func:`two_model_recs` ordered by user for looking up single users."""
    return _stage(spark, sf_dir, "lookup", tuple(sorted({*_INTER, *_ITEMS, *_VECS})), p,
                  lambda: lookup_table(two_model_recs(spark, sf_dir, p)))


def facts_by_user(spark: SparkSession, sf_dir: str, p: Params = P) -> UserFacts:
    """Train, test and both deterministic models' recommendations in one table bucketed by user, written once."""
    def build():
        return user_facts(train_set(spark, sf_dir, p, True), test_set(spark, sf_dir, p, True),
                          compact_ranks(two_model_recs(spark, sf_dir, p)))
    return _stage(spark, sf_dir, "by_user", tuple(sorted({*_INTER, *_ITEMS, *_VECS})), p, build)


# ------------------------------------------------- a user's own tables
#: The reference's own model parameters, for a user's tables (``P`` holds those of the registered queries).
REFERENCE = Params(k=ALS.DEFAULT_K, als_rank=ALS.DEFAULT_RANK, als_iter=ALS.DEFAULT_ITER, als_reg=ALS.DEFAULT_REG)


@dataclass
class Recommender:
    """Stage outputs of :func:`recommend`."""

    catalog: DataFrame
    train: DataFrame
    test: DataFrame
    removed: DataFrame      # training rows outside the catalogue, by model input
    recs: DataFrame         # model, user_id, item_id, score, rank
    board: DataFrame        # model, K, precision, recall, ndcg, n_users_evaluated


def recommend(raw: DataFrame, interactions: DataFrame, spec: CatalogSpec | None = None, p: Params = REFERENCE,
              k: int = ALS.DEFAULT_K, epochs: int = AE.EPOCHS, steps_per_epoch: int = AE.STEPS_PER_EPOCH) -> Recommender:
    """The whole pipeline over given raw items and interactions ``(user_id, item_id[, play])``.

    ``raw`` has the id, name and artists columns of ``spec`` and any of its
    features (the reference's by default); ids may be text.  The models are fitted
    with the reference's parameters unless others are given.  Catalogue, split,
    collaborative and autoencoder recommendations and their leaderboard, each
    written once to the shared folder.
    """
    from tastebud.operators.catalog import REFERENCE_FEATURES, available_features
    from tastebud.operators.interactions import implicit
    spec = spec or CatalogSpec(feature_cols=[*REFERENCE_FEATURES, "popularity"])
    feats, _ = available_features(raw, spec.feature_cols)
    cat = materialize(prepare_catalog(raw, spec).withColumnRenamed(spec.id_col, "item_id"))
    tagged = materialize(assign_split(implicit(interactions), seed=p.seed, train_ratio=p.train_ratio,
                                      min_interactions=p.min_interactions), ("is_train",))
    cols = ["user_id", "item_id", "play", "pos"]
    train, test = tagged.where("is_train").select(*cols), tagged.where("NOT is_train").select(*cols)
    ctrain = materialize(train.join(cat.select("item_id"), "item_id", "left_semi"))
    n = train.agg(F.count(F.lit(1)).alias("n_train"))
    n = n.select("n_train", ctrain.agg(F.count(F.lit(1)).alias("n")).scalar().alias("n_in_catalog"))
    removed = n.select("n_train", "n_in_catalog", (F.col("n_train") - F.col("n_in_catalog")).alias("n_removed"))
    fit = ALS.fit_als(ctrain, rank=p.als_rank, max_iter=p.als_iter, reg=p.als_reg, alpha=p.als_alpha, seed=p.seed)
    vecs = AE.training_input(vectors_to_array(standardized_features(cat, feats), feats, out_col="vec"), "item_id", "vec")
    params, _ = AE.train(vecs, len(feats), epochs=epochs, steps_per_epoch=steps_per_epoch, seed=p.seed)
    content = content_recommend(train, AE.encode(vecs, params), k, materialize_items=True)
    recs = materialize(model_recs(ALS.als_recommend(fit, ctrain, k), "als")
                       .unionByName(model_recs(content, "autoencoder")))
    return Recommender(cat, train, test, removed, recs, leaderboard(compact_ranks(recs), test, p.ks))
