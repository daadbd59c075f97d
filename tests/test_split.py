"""Per-user split sizes and the skew-safe positional ranking."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tastebud.functions.hashing import order_key
from tastebud.operators.ranking import hashed_position
from tastebud.operators.split import assign_split, remove_test_overlap

SIZES = {1: None, 2: (1, 1), 3: (2, 1), 4: (3, 1), 5: (4, 1), 9: (7, 2), 10: (8, 2), 60: (48, 12)}


def test_split_sizes(spark):
    rows = [(n, i) for n in SIZES for i in range(n)]
    df = spark.createDataFrame(rows, "user_id long, item_id long")
    got = {r.user_id: (r.tr, r.te) for r in assign_split(df).groupBy("user_id").agg(
        F.sum(F.col("is_train").cast("int")).alias("tr"), F.sum((~F.col("is_train")).cast("int")).alias("te")).collect()}
    for n, want in SIZES.items():
        assert got.get(n) == want


@pytest.mark.parametrize("target", [3, 50, 10_000])
def test_hot_group_positions_match_plain_window(spark, target):
    # user 0 is "hot" (a third of all rows); others are small
    rows = [(0, i) for i in range(400)] + [(u, i) for u in range(1, 80) for i in range(10)]
    df = spark.createDataFrame(rows, "user_id long, item_id long").withColumn("_key", order_key(7, "user_id", "item_id"))
    got = hashed_position(df, ["user_id"], "_key", ["item_id"], target_rows=target)
    want = df.withColumn("pos2", F.row_number().over(Window.partitionBy("user_id").orderBy("_key", "item_id"))) \
             .withColumn("n2", F.count(F.lit(1)).over(Window.partitionBy("user_id")))
    j = got.join(want, ["user_id", "item_id"])
    assert j.count() == len(rows)
    assert j.where((F.col("pos") != F.col("pos2")) | (F.col("n") != F.col("n2"))).count() == 0


def test_overlap_removed(spark):
    tr = spark.createDataFrame([(1, 1), (1, 2)], "user_id long, item_id long")
    te = spark.createDataFrame([(1, 2), (1, 3)], "user_id long, item_id long")
    assert [tuple(r) for r in remove_test_overlap(tr, te).collect()] == [(1, 3)]


@pytest.mark.parametrize("target", [50, 10_000])
def test_hot_repeated_pair_is_numbered_like_a_plain_window(spark, target):
    rows = [(0, 7)] * 300 + [(0, i) for i in range(100)] + [(u, i % 4) for u in range(1, 30) for i in range(10)]
    df = spark.createDataFrame(rows, "user_id long, item_id long").withColumn("_key", order_key(7, "user_id", "item_id"))
    got = hashed_position(df, ["user_id"], "_key", ["item_id"], target_rows=target)
    w = Window.partitionBy("user_id")
    want = (df.withColumn("pos", F.row_number().over(w.orderBy("_key", "item_id")).cast("long"))
            .withColumn("n", F.count(F.lit(1)).over(w)))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_split_exchanges_rows_without_their_keys_and_sorts_them_in_enough_tasks(spark):
    from tastebud.operators.ranking import SORT_ROWS, _sort_tasks
    df = spark.createDataFrame([(i % 50, i) for i in range(3000)], "user_id long, item_id long")
    keyed = df.withColumn("_key", order_key(42, "user_id", "item_id"))
    want = {(r.user_id, r.item_id): (r.pos, r.n) for r in hashed_position(keyed, ["user_id"], "_key", ["item_id"]).collect()}
    for target in (2_000_000, 25):  # without and with hot users
        got = assign_split(df, target_rows=target)
        assert got.columns == ["user_id", "item_id", "pos", "n", "n_train", "is_train"]
        assert {(r.user_id, r.item_id): (r.pos, r.n) for r in got.collect()} == want
    plan = assign_split(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and "md5" not in plan[plan.index("RepartitionByExpression"):]  # below the exchange
    assert _sort_tasks(0, 8) == 1 and _sort_tasks(3000, 8) == 1 and _sort_tasks(10 ** 6, 8) == 8
    assert _sort_tasks(216 * SORT_ROWS, 12) == 216
