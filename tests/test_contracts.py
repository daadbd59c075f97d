"""Argument and schema checks."""

import pytest

from tastebud.operators.reports import check_k
from tastebud.sources.io import require_columns


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "user_id long, item_id long")
    require_columns(df, ["user_id", "item_id"])
    with pytest.raises(ValueError, match="play"):
        require_columns(df, ["user_id", "play"], "interactions")


@pytest.mark.parametrize("k,ok", [(1, True), (10, True), (100, True), (0, False), (101, False), ("5", False)])
def test_check_k(k, ok):
    if ok:
        assert check_k(k) == k
    else:
        with pytest.raises(ValueError):
            check_k(k)


def test_registry_has_oracle_for_sql_expressible_queries():
    import __spark_entry__ as E
    rows_only = set(E.queries()) - set(E.oracle_sql()) - set(E._corpus()[0])
    # only scores of fitted models (ALS, trained autoencoder) and what a scorer skipped lack an SQL statement
    assert rows_only <= {"als_topk", "als_leaderboard", "ae_topk", "evaluation_report", "topk_block_visits"}
    assert set(E.oracle_sql()) <= set(E.queries())


def test_checkpoint_folder_is_asked_for_on_a_cluster():
    from tastebud.session import checkpoint_dir

    class Nowhere:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="checkpoint"):
        checkpoint_dir(Nowhere)


def test_operators_name_missing_columns(spark):
    from tastebud.operators.als import fit_als
    from tastebud.operators.ranking import dedup_keep_first
    from tastebud.operators.split import assign_split
    df = spark.createDataFrame([(1, 2)], "user_id long, x long")
    for call in (lambda: assign_split(df), lambda: fit_als(df)):
        with pytest.raises(ValueError, match="item_id"):
            call()
    with pytest.raises(ValueError, match="order"):
        dedup_keep_first(df, ["user_id"], ["user_id"])


def test_interaction_stats_approx_close(spark):
    from pyspark.sql import functions as F
    from tastebud.operators.interactions import interaction_stats
    df = spark.range(20000).select((F.col("id") % 997).alias("user_id"), (F.col("id") % 1009).alias("item_id"))
    exact = interaction_stats(df).first()
    approx = interaction_stats(df, approx=True).first()
    assert (exact.n_users, exact.n_items) == (997, 1009)
    assert abs(approx.n_users - 997) / 997 < 0.05 and abs(approx.n_items - 1009) / 1009 < 0.05


def test_stage_outputs_are_released(spark):
    from tastebud.plans.pipeline import clear_stage_outputs
    from tastebud.session import materialize, release_stages
    df = materialize(spark.range(10).selectExpr("id", "id % 2 = 0 AS even"), ("even",))
    assert df.where("even").count() == 5
    clear_stage_outputs(spark)  # forgets what other tests remembered, too
    assert release_stages(spark) == 0
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FAILED_READ_FILE"):
        df.select("id").collect()
