"""Vector operators, indexing, prefix sums, dedup, sampling."""

import numpy as np
from pyspark.sql import functions as F

from tastebud.operators.ranking import dedup_keep_first, dense_index
from tastebud.operators.sampling import negative_samples, prefix_sums, weighted_group_pick
from tastebud.operators.vectors import mean_vectors, mean_vectors_exploded, standardize


def test_mean_vectors_forms_agree(spark):
    rng = np.random.RandomState(0)
    rows = [(int(u), rng.randn(4).tolist()) for u in rng.randint(0, 7, 60)]
    df = spark.createDataFrame(rows, "u long, v array<double>")
    a = {r.u: r.p for r in mean_vectors(df, "u", "v", "p").collect()}
    b = {r.u: r.p for r in mean_vectors_exploded(df, "u", "v", "p").collect()}
    for u in a:
        want = np.mean([v for uu, v in rows if uu == u], axis=0)
        assert np.allclose(a[u], want) and np.allclose(b[u], want)


def test_standardize_population_std_and_constant(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 4.0, 5.0)], "id long, x double, c double")
    got = {r.id: (r.x, r.c) for r in standardize(df, ["x", "c"], ["id"]).collect()}
    x = np.array([1.0, 2.0, 4.0])
    z = (x - x.mean()) / x.std()
    assert all(abs(got[i + 1][0] - z[i]) < 1e-12 and got[i + 1][1] == 0.0 for i in range(3))


def test_dense_index(spark):
    ids = [5, 3, 3, 99, -2, 1000, 7]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r.idx for r in dense_index(df, "id", num_partitions=3).collect()}
    assert got == {v: i for i, v in enumerate(sorted(set(ids)))}


def test_dense_index_does_not_need_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = dense_index(spark.range(300_000).select((F.col("id") * 7).alias("id")), "id", num_partitions=6)
        r = got.agg(F.count("*").alias("n"), F.countDistinct("idx").alias("d"), F.max("idx").alias("m"),
                    F.count(F.when(F.col("id") != F.col("idx") * 7, 1)).alias("bad")).first()
        assert (r.n, r.d, r.m, r.bad) == (300_000, 300_000, 299_999, 0)
        groups = spark.range(5000).select(F.col("id").alias("g"), F.lit(1.0).alias("w"))
        c = prefix_sums(groups, "g", "w", "cum", num_partitions=5)
        assert c.where(F.col("cum") == F.col("g") + 1).count() == 5000
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_prefix_sums(spark):
    df = spark.createDataFrame([(c, float(i + 1)) for i, c in enumerate("qwertyuiop")], "g string, w double")
    got = {r.g: r.cum for r in prefix_sums(df, "g", "w", "cum", num_partitions=4).collect()}
    run, want = 0.0, {}
    for g, w in sorted((c, float(i + 1)) for i, c in enumerate("qwertyuiop")):
        run += w
        want[g] = run
    assert got == want


def test_dedup_keep_first(spark):
    df = spark.createDataFrame([(1, 1, "late"), (1, 0, None), (2, 0, "b")], "id long, o int, name string")
    got = {r.id: r.name for r in dedup_keep_first(df, ["id"], ["o"]).collect()}
    assert got == {1: None, 2: "b"}


def test_weighted_group_pick_frequencies(spark):
    users = spark.range(4000).select(F.col("id").alias("user_id"))
    groups = spark.createDataFrame([("a", 1), ("b", 3), ("c", 6)], "group string, n long")
    got = {r.picked_group: r["count"] for r in weighted_group_pick(users, groups, n_bins=4).groupBy("picked_group").count().collect()}
    assert sum(got.values()) == 4000
    assert abs(got["c"] / 4000 - 0.6) < 0.05 and abs(got["a"] / 4000 - 0.1) < 0.03


def test_negative_samples_exclude_owned(spark):
    cat = spark.range(50).select(F.col("id").alias("item_id"), F.col("id").alias("idx"))
    owned = [(1, i) for i in range(0, 50, 2)] + [(2, i) for i in range(48)]
    inter = spark.createDataFrame(owned, "user_id long, item_id long")
    got = negative_samples(inter, cat, 5, chunk=7).collect()
    by = {}
    for r in got:
        by.setdefault(r.user_id, []).append((r.neg_pos, r.item_id))
    assert sorted(p for p, _ in by[1]) == [1, 2, 3, 4, 5]
    assert all(i % 2 == 1 for _, i in by[1])
    assert sorted(i for _, i in by[2]) == [48, 49]
