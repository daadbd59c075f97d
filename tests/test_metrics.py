"""Ranking metrics against the hand-made cases of FIXTURES §3."""

import pytest

from tastebud.operators.evaluation import compact_ranks, leaderboard, per_user_metrics

CASES = [
    # (recs as (rank, item), truth items, K, precision, recall, ndcg)
    ([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")], ["b", "e", "z"], 5, 0.4, 0.666667, 0.477624),
    ([(1, "x"), (2, "b")], ["b"], 5, 0.2, 1.0, 0.63093),
    ([(1, "b"), (2, "b")], ["b"], 5, 0.4, 2.0, 1.63093),
    ([(1, "a"), (3, "b"), (7, "c")], ["c"], 3, 0.333333, 1.0, 0.5),
]


def _frames(spark, recs, truth, user=1):
    ids = {s: i for i, s in enumerate("abcdexz")}
    r = spark.createDataFrame([("m", user, ids[it], float(10 - rk), rk) for rk, it in recs],
                              "model string, user_id long, item_id long, score double, rank int")
    t = spark.createDataFrame([(user, ids[it]) for it in truth], "user_id long, item_id long")
    return r, t


@pytest.mark.parametrize("recs,truth,k,p,r,n", CASES)
def test_cases(spark, recs, truth, k, p, r, n):
    rdf, tdf = _frames(spark, recs, truth)
    row = per_user_metrics(compact_ranks(rdf), tdf, ks=[k]).first()
    assert row.precision == pytest.approx(p, abs=1e-6)
    assert row.recall == pytest.approx(r, abs=1e-6)
    assert row.ndcg == pytest.approx(n, abs=1e-5)


def test_user_without_recs_left_out(spark):
    rdf, tdf = _frames(spark, [(1, "b")], ["b"], user=1)
    t2 = spark.createDataFrame([(2, 3)], "user_id long, item_id long")
    board = leaderboard(compact_ranks(rdf), tdf.unionByName(t2), ks=[5]).first()
    assert board.n_users_evaluated == 1
    assert board.recall == 1.0


def test_duplicate_rank_keeps_one(spark):
    r = spark.createDataFrame([("m", 1, 1, 0.9, 1), ("m", 1, 2, 0.8, 1), ("m", 1, 3, 0.7, 2)],
                              "model string, user_id long, item_id long, score double, rank int")
    pos = sorted((x.item_id, x.pos) for x in compact_ranks(r).collect())
    assert pos == [(2, 1), (3, 2)]
