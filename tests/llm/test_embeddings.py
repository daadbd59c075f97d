"""Embedding near-duplicates against all pairs in double precision."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastebud.llm import embed_dedup
from tastebud.llm.common import prepare
from tests.llm import brute as B


def brute(rows, min_cosine=0.93):
    """(n_links, component_id) of every (id, vector, label) row."""
    def usable(v, label):
        return (label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v))
    unit = [np.array(v) / np.max(np.abs(v)) if usable(v, label) else None for _, v, label in rows]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    pairs, links = [], [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= min_cosine:
                pairs.append((i, j))
                links[i] += 1
                links[j] += 1
    root, low = B.components(len(rows), pairs), {}
    for r, (i, _, _) in zip(root, rows):
        key = (i is None, i or 0)
        low[r] = min(low.get(r, key), key)
    return links, [None if low[r][0] else low[r][1] for r in root]


@pytest.mark.parametrize("block", [2048, 20])
def test_against_all_pairs(spark, monkeypatch, block):
    prepare(spark)
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1):
        base = rng.standard_normal((25, 16))
        for i, v in enumerate(base):
            rows.append((len(rows), v.tolist(), label))
            for _ in range(i % 3):  # near and exact copies, some just above or below the threshold
                rows.append((len(rows), (v + rng.standard_normal(16) * rng.choice([0, 0.1, 0.3, 0.37, 0.42])).tolist(), label))
    hot = rng.standard_normal(16)
    rows += [(1000 + i, hot.tolist(), 1) for i in range(40)] + [(2000 + i, (hot * (i + 1)).tolist(), 1) for i in range(5)]
    bad = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] + [0.0] * 15]
    rows += [(3000 + i, v, 1) for i, v in enumerate(bad)] + [(4000, hot.tolist(), None), (4001, hot.tolist(), 0),
                                                             (4002, [1.0, 2.0], 1), (4003, [2.0, 4.0], 1),
                                                             (4004, [1e200] * 16, 0), (4005, [1e-200] * 16, 0),
                                                             (None, hot.tolist(), 1), (None, None, None), (1000, hot.tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("x"))
    df = df.withColumn("code", F.lit(None).cast("string"))
    links, comp = brute(rows)
    key = lambda i, n, c: (i is None, i or 0, n, c is None, c or 0)
    got = sorted(key(r.vec_id, r.n_links, r.component_id) for r in embed_dedup.near_vectors(df).collect())
    assert got == sorted(key(i, n, c) for (i, _, _), n, c in zip(rows, links, comp))
    assert embed_dedup.near_vectors(df.where("vec_id < 0")).count() == 0


def test_estimates_are_unbiased_and_within_their_bounds():
    rng = np.random.default_rng(1)
    dim = 64
    x, q = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in rng.standard_normal((2, 400, dim)))
    true = (x * q).sum(axis=1)
    est = np.zeros(400)
    for seed in range(40):
        rot = embed_dedup.rotation(dim, seed)
        assert np.allclose(rot @ rot.T, np.eye(dim))
        code, f = embed_dedup.codes_of(x, rot)
        e = (embed_dedup.signs(code, dim) * (q @ rot)).sum(axis=1) / f
        est += e / 40
        bound = embed_dedup.EPS * np.sqrt((1 - f ** 2) / f ** 2 / (dim - 1))
        assert (np.abs(e - true) <= bound).all()
    assert abs((est - true).mean()) < 0.005 and np.abs(est - true).max() < 0.15


def test_bounds_of_rounded_vectors_hold_and_leave_a_narrow_band():
    rng = np.random.default_rng(3)
    dim = 64
    rot = embed_dedup.rotation(dim)
    x = embed_dedup.unit_vectors(rng.standard_normal((300, dim)))
    y = embed_dedup.unit_vectors(x + rng.standard_normal((300, dim)) * rng.uniform(0, 0.09, (300, 1)))
    sides = []
    for v in (x, y):
        code, f = embed_dedup.codes_of(v, rot)
        sides.append(embed_dedup.Coded(code, f, *embed_dedup.whole_numbers(v @ rot)))
    true = (x * y).sum(axis=1)
    at = np.arange(300)
    sure, open_ = embed_dedup.decide(*sides, at, at, 0.93)
    assert (true[sure] >= 0.93).all() and (true[~sure & ~open_] < 0.93).all()
    assert sure.sum() > 50 and (np.abs(true[open_] - 0.93) < 0.04).all()
    i, j = embed_dedup.may_link(*sides, 0.93)
    assert {int(k) for k in np.flatnonzero(true >= 0.93)} <= {int(a) for a, b in zip(i, j) if a == b}


def test_pairs_at_the_threshold_are_decided_in_double_precision(spark):
    """Cosines within 1e-12 to 1e-3 of the threshold, on both sides, are all left open by the bytes."""
    prepare(spark)
    rng = np.random.default_rng(8)
    rows = []
    for k in range(12):
        a, b = (v / np.linalg.norm(v) for v in rng.standard_normal((2, 32)))
        b = embed_dedup.unit_vectors((b - (a @ b) * a)[None])[0]
        for off in (0.0, 1e-12, 1e-6, 1e-3):
            for sign in (1, -1):
                c = 0.93 + sign * off + sign * 1e-14
                rows.append((len(rows), (a * c + b * np.sqrt(1 - c * c)).tolist(), k))
        rows.append((len(rows), a.tolist(), k))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    links, comp = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_vectors(df).collect()}
    assert got == {i: (n, c) for (i, _, _), n, c in zip(rows, links, comp)}


def test_blocks_apart_in_angle_do_not_meet(spark, monkeypatch):
    """Tight clusters in one label: blocks meet within clusters only, and no link is lost."""
    prepare(spark)
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(13)
    base = embed_dedup.unit_vectors(rng.standard_normal((6, 24)))
    rows = [(len(base) * i + k, (v + rng.standard_normal(24) * 0.06).tolist(), 1) for i in range(60) for k, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    seen, real = [], embed_dedup.angle_cells

    def spy(coded, cap, min_cosine):
        out = real(coded, cap, min_cosine)
        seen.append(out.select("blk", "bi", "bj").distinct().collect())
        return out

    monkeypatch.setattr(embed_dedup, "angle_cells", spy)
    links, comp = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_vectors(df).collect()}
    assert got == {i: (n, c) for (i, _, _), n, c in zip(rows, links, comp)}
    assert sum(links) > 1000
    blocks = len({r.blk for r in seen[0]})
    met = len({(r.bi, r.bj) for r in seen[0]})
    assert blocks >= 10 and met < blocks * (blocks + 1) / 2 * 0.7
