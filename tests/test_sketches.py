"""Theta and KLL sketches against exact sets and ranks; lookup tables read one row group."""

import numpy as np
from pyspark.sql import functions as F

from tastebud.operators import sketches as SK
from tastebud.operators.reports import lookup_table


def test_set_sizes_within_bounds_one_pass_and_by_parts(spark):
    n = 60_000  # far beyond the entries of a sketch
    rows = spark.range(n).select(F.explode(F.array(
        F.when(F.col("id") % 2 == 0, "even"), F.when(F.col("id") % 3 == 0, "third"),
        F.when(F.col("id") % 2 == 1, "odd"))).alias("set_name"), F.col("id").cast("string").alias("key"))
    rows = rows.where("set_name IS NOT NULL").unionByName(
        spark.createDataFrame([("even", None), ("even", "0")], "set_name string, key string"))
    pairs = [("even", "third"), ("even", "odd"), ("third", "third")]
    exact = {(r.a, r.b, r.op): r.exact_size for r in SK.exact_set_sizes(rows, pairs).collect()}
    assert exact["even", "third", "intersection"] == 10_000 and exact["even", "odd", "union"] == n
    parts = SK.set_sketches(rows.withColumn("part", F.crc32("key") % 5), ("set_name", "part"))
    for sketches in (SK.set_sketches(rows), SK.merge_set_sketches(parts)):
        got = SK.sketch_set_sizes(sketches, pairs).collect()
        assert len(got) == 9
        for r in got:
            want = exact[r.a, r.b, r.op]
            assert abs(r.estimate - want) <= r.bound
            assert want == 0 or r.bound < 0.35 * max(want, 10_000)
        assert any(r.estimate != exact[r.a, r.b, r.op] for r in got)  # estimates, not counts
    empty = rows.where("false")
    assert SK.sketch_set_sizes(SK.set_sketches(empty), pairs).count() == 0
    assert {r.exact_size for r in SK.exact_set_sizes(empty, pairs).collect()} == {0}


def test_quantiles_within_rank_error_after_merging(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.geometric(0.01, 30_000), np.full(10_000, 5)])  # a tie of a quarter of all
    df = spark.createDataFrame([("x", int(v)) for v in values], "g string, c long").withColumn("part", F.crc32(F.col("c").cast("string")) % 7)
    merged = SK.merge_count_sketches(SK.count_sketches(df, ("g", "part"), "c"), ("g",))
    qs = (0.0, 0.1, 0.5, 0.9, 0.99, 1.0)
    found = SK.sketch_quantiles(merged, qs).cache()
    for r in found.collect():
        eps = SK.kll_rank_error()
        assert (values < r.value).mean() <= r.quantile + eps and (values <= r.value).mean() >= r.quantile - eps and r.n == len(values)
    assert [r.within for r in SK.rank_check(found, df, ("g",), "c").collect()] == [True] * len(qs)
    wrong = found.withColumn("value", F.col("value") + 100)
    assert not all(r.within for r in SK.rank_check(wrong, df, ("g",), "c").collect())


def _rows_scanned(df) -> int:
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookup_reads_one_row_group(spark):
    recs = spark.range(6000).select((F.col("id") % 600 * 2).cast("string").alias("user_id"), F.lit("m").alias("model"),
                                    (F.col("id") / 600).cast("int").alias("rank"))
    table = lookup_table(recs, row_group_rows=100)
    assert table.count() == 6000
    for user in ("0", "400", "1198"):
        mine = table.where(F.col("user_id") == user)
        assert _rows_scanned(mine) <= 200
        assert sorted(r["rank"] for r in mine.collect()) == list(range(10))
    assert _rows_scanned(table.where(F.col("user_id") == "401")) <= 100  # between two users: the Bloom filter
    assert recs.where("false").transform(lookup_table).count() == 0
