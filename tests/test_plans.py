"""Physical-plan properties that matter at scale."""

import re

from pyspark.sql import functions as F

from tastebud.functions.hashing import order_key
from tastebud.operators.ranking import hashed_position
from tastebud.sources import tables as TB

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_interaction_scan_prunes_columns(spark):
    plan = _plan(TB.interactions(spark, SF))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", df_explain(TB.interactions(spark, SF)))
    assert "struct<l_orderkey:bigint,l_partkey:bigint>" in schemas
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in schemas
    assert "l_quantity" not in plan


def df_explain(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_split_without_hot_groups_is_one_shuffle(spark):
    rows = [(u, i) for u in range(30) for i in range(20)]
    df = spark.createDataFrame(rows, "user_id long, item_id long").withColumn("_key", order_key(1, "user_id", "item_id"))
    ranked = hashed_position(df, ["user_id"], "_key", ["item_id"])
    plan = _plan(ranked)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastExchange" not in plan


def test_filter_on_user_reaches_scan(spark):
    q = TB.interactions(spark, SF).where(F.col("user_id") == 7)
    text = df_explain(q)
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,7)" in text or "EqualTo(o_custkey,7)" in text
