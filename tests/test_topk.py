"""Blocked top-K scoring against brute force."""

import numpy as np
import pyarrow as pa
import pytest

from tastebud.operators.topk import top_k_scores


def brute(U, I, uids, iids, seen, k, metric):
    out = []
    for a, u in enumerate(uids):
        cand = []
        for b, i in enumerate(iids):
            if (u, i) in seen:
                continue
            if metric == "cosine":
                nu, ni = np.linalg.norm(U[a]), np.linalg.norm(I[b])
                s = float(U[a] @ I[b] / (nu * ni)) if nu > 0 and ni > 0 else 0.0
            else:
                s = float(U[a] @ I[b])
            cand.append((round(s, 6), i))
        cand.sort(key=lambda x: (-x[0], x[1]))
        out += [(u, i, s, r + 1) for r, (s, i) in enumerate(cand[:k])]
    return sorted(out)


@pytest.mark.parametrize("metric,ub,ib", [("cosine", 1, 1), ("cosine", 3, 4), ("dot", 2, 3), ("cosine", None, None), ("dot", None, None)])
def test_matches_brute_force(spark, metric, ub, ib):
    rng = np.random.RandomState(3)
    nu, ni, d, k = 23, 41, 5, 7
    U = rng.randint(-2, 3, (nu, d)).astype(float)   # small integers: many exact ties
    I = rng.randint(-2, 3, (ni, d)).astype(float)
    U[0] = 0.0                                      # zero profile -> all scores 0
    I[1] = 0.0
    uids, iids = list(range(100, 100 + nu)), list(range(500, 500 + ni))
    seen = {(u, i) for u in uids for i in iids if (u * 7 + i) % 5 == 0}
    seen |= {(uids[1], i) for i in iids}            # a user who has seen everything
    users = spark.createDataFrame([(u, U[a].tolist()) for a, u in enumerate(uids)], "user_id long, vec array<double>")
    items = spark.createDataFrame([(i, I[b].tolist()) for b, i in enumerate(iids)], "item_id long, vec array<double>")
    sdf = spark.createDataFrame(sorted(seen), "user_id long, item_id long")
    got = top_k_scores(users, items, k, seen=sdf, metric=metric, n_user_blocks=ub, n_item_blocks=ib)
    got = sorted((r.user_id, r.item_id, r.score, r.rank) for r in got.collect())
    assert got == brute(U, I, uids, iids, seen, k, metric)


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_half_way_scores_rank_alike_in_all_block_counts(spark, metric):
    # scores on the edge of the sixth decimal: 0.0000005, 0.0000015, ...
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5])], "user_id long, vec array<double>")
    items = spark.createDataFrame([(i, [(i % 40) * 1e-6 + 5e-7, 1.0 + (i % 3)]) for i in range(300)],
                                  "item_id long, vec array<double>")
    got = []
    for blocks in (None, 1, 4, 9):
        r = top_k_scores(users, items, 250, metric=metric, n_item_blocks=blocks).collect()
        got.append(sorted((x.user_id, x.rank, x.item_id, x.score) for x in r))
    assert len(got[0]) == 500 and all(g == got[0] for g in got)
    for a, b in zip(got[0], got[0][1:]):  # score descending, then id ascending
        assert a[0] != b[0] or a[3] > b[3] or (a[3] == b[3] and a[2] < b[2])


def test_text_ids_and_profiles_beyond_one_block(spark):
    from tastebud.operators.content import content_recommend
    rng = np.random.RandomState(5)
    V = rng.randint(-2, 3, (30, 4)).astype(float)
    pairs = [(u, int(i)) for u in range(9) for i in rng.choice(30, 5)]  # repeated pairs weigh in
    train = spark.createDataFrame(pairs, "user_id long, item_id long")
    vecs = spark.createDataFrame([(i, V[i].tolist()) for i in range(28)], "item_id long, vec array<double>")
    one = sorted(tuple(r) for r in content_recommend(train, vecs, 6).collect())
    many = sorted(tuple(r) for r in content_recommend(train, vecs, 6, item_block_bytes=64).collect())
    assert one == many
    U = {u: np.mean([V[i] for v, i in pairs if v == u and i < 28], axis=0) for u in range(9)}
    want = brute(np.stack([U[u] for u in range(9)]), V[:28], list(range(9)), list(range(28)), set(pairs), 6, "cosine")
    assert [(u, i, r) for u, i, _, r in one] == [(u, i, r) for u, i, _, r in want]
    text = content_recommend(train.selectExpr("concat('u', user_id) user_id", "concat('i', lpad(item_id, 3, '0')) item_id"),
                             vecs.selectExpr("concat('i', lpad(item_id, 3, '0')) item_id", "vec"), 6)
    assert sorted((int(r.user_id[1:]), int(r.item_id[1:]), r.score, r.rank) for r in text.collect()) == one


def test_profiles_formed_in_the_block_are_the_joined_means(spark):
    from tastebud.operators.topk import profile_vectors
    from tastebud.operators.vectors import mean_vectors
    rng = np.random.RandomState(6)
    pairs = [(u if u else None, int(i)) for u in range(40) for i in rng.choice(30, 7)] + [(77, 29)]  # a null user, unknown items
    train = spark.createDataFrame(pairs, "user_id long, item_id long")
    items = spark.createDataFrame([(i, rng.randn(4).tolist()) for i in range(26)], "item_id long, vec array<double>")
    want = {r.user_id: r.vec for r in mean_vectors(train.join(items, "item_id"), "user_id", "vec", "vec").collect()}
    got = profile_vectors(train, items)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "vec" not in plan.split("MapInArrow")[1].split("\n", 1)[1].split("LeftSemi")[0]  # ids alone are grouped
    for frame in (got, profile_vectors(train, items, item_block_bytes=8), profile_vectors(train, items.union(items.limit(0)))):
        rows = {r.user_id: r.vec for r in frame.collect()}
        assert rows.keys() == want.keys() and all(np.allclose(rows[u], want[u], atol=1e-12) for u in want)
    twice = items.unionByName(items.where("item_id < 9"))
    a = {r.user_id: r.vec for r in profile_vectors(train, twice).collect()}
    b = {r.user_id: r.vec for r in mean_vectors(train.join(twice, "item_id"), "user_id", "vec", "vec").collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[u], b[u], atol=1e-12) for u in a)


def test_users_of_many_small_batches_are_searched_together(spark, monkeypatch):
    from tastebud.operators import topk
    rng = np.random.default_rng(5)
    rows = [(u, [None, [], [{"i": u, "c": 1}]][u % 3]) for u in range(100)]
    kind = pa.schema([("user_id", pa.int64()), ("seen", pa.list_(pa.struct([("i", pa.int64()), ("c", pa.int64())])))])
    batches = [pa.RecordBatch.from_pylist([dict(zip(kind.names, r)) for r in rows[a:a + 3]], schema=kind) for a in range(0, 100, 3)]
    got = list(topk._gathered([*batches[:5], batches[0].slice(0, 0), *batches[5:]], 40))
    assert [b.num_rows for b in got] == [42, 42, 16]
    assert [tuple(r.values()) for b in got for r in b.to_pylist()] == rows
    assert [topk._packed_lists(b.column("seen"))[1].sum() for b in got] == [14, 14, 5]
    assert len(list(topk._gathered(batches, 40, batches[0].nbytes))) == len(batches)
    # the same rows whatever the batches
    users = spark.createDataFrame([(u, rng.normal(size=4).tolist()) for u in range(60)], "user_id long, vec array<double>").coalesce(1)
    items = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(50)], "item_id long, vec array<double>")
    seen = spark.createDataFrame([(u, (3 * u + j) % 50) for u in range(0, 60, 2) for j in range(4)], "user_id long, item_id long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = []
    for n in ("7", "1000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
        try:
            got.append([sorted(map(tuple, top_k_scores(users, items, 6, seen, "dot").collect())),
                        sorted(map(tuple, topk.profile_top_k(seen, items, 6).collect()))])
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got[0] == got[1] and [len(g) for g in got[0]] == [360, 180]


def test_sorted_rows_come_in_whole_users():
    import pyarrow as pa
    from tastebud.operators.ranking import long_ids, whole_groups
    ids = np.repeat(np.arange(40) * 3, np.arange(40) % 7 + 1)
    rows = pa.table({"u": pa.array([None, None, *ids.tolist()], pa.int64()), "i": np.arange(len(ids) + 2)})
    batches = [b for b in rows.to_batches(max_chunksize=11)]
    for groups, size in ((5, 1 << 20), (1000, 1 << 20), (1000, 1), (1, 1 << 20)):
        got = list(whole_groups([batches[0].slice(0, 0), *batches], "u", groups, size))
        assert pa.concat_tables(got).equals(rows)
        users = [set(long_ids(t.column("u")).tolist()) for t in got]
        assert sum(map(len, users)) == len(set().union(*users)) == 41  # no user in two tables
        assert groups == size == 1000 or (len(got) > 1) == (groups < 41 or size == 1)


def test_one_scoring_task_per_core(spark):
    from tastebud.operators.topk import profile_top_k, top_k_scores
    pairs = spark.range(3000).selectExpr("id % 700 as user_id", "(id * 7) % 97 as item_id")
    items = spark.range(97).selectExpr("id as item_id", "array(sin(id), cos(id), 0.1D * id) as vec")
    cores = spark.sparkContext.defaultParallelism
    assert profile_top_k(pairs, items, 5).rdd.getNumPartitions() == cores
    users = items.selectExpr("item_id as user_id", "vec")
    assert top_k_scores(users, items, 5, pairs, "dot").rdd.getNumPartitions() == cores


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_catalogues_of_several_pieces_copy_neither_users_nor_items(spark, monkeypatch, metric):
    from tastebud.operators import topk
    rng = np.random.default_rng(8)
    V = rng.integers(-2, 3, (400, 4)).astype(float)  # many ties, within a piece and between pieces
    items = spark.createDataFrame([(i * 3, v.tolist()) for i, v in enumerate(V)], "item_id long, vec array<double>")
    users = spark.createDataFrame([(u, rng.normal(size=4).round(1).tolist()) for u in range(90)], "user_id long, vec array<double>")
    seen = spark.createDataFrame([(u, int(i) * 3) for u in range(0, 90, 2) for i in rng.choice(420, 40)] +
                                 [(1, i * 3) for i in range(400)], "user_id long, item_id long")
    monkeypatch.setattr(topk, "GATHER_BYTES", 16 * 500 * 20)  # several rounds of users pass the pieces
    for k in (7, 500):
        want = sorted(map(tuple, top_k_scores(users, items, k, seen, metric).collect()))
        got = top_k_scores(users, items, k, seen, metric, item_block_bytes=400 * 4 * 8 // 5)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "CoGroups" not in plan
        assert sorted(map(tuple, got.collect())) == want
    beyond = top_k_scores(users, items, 7, seen, metric, item_block_bytes=400 * 4 * 8 // (topk.MAX_PIECES + 1))
    assert "CoGroups" in beyond._jdf.queryExecution().optimizedPlan().toString()


def test_profiles_over_several_pieces_are_formed_from_ids(spark):
    from tastebud.operators.topk import profile_top_k
    rng = np.random.default_rng(9)
    items = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(60)], "item_id long, vec array<double>")
    pairs = spark.createDataFrame([(u, int(i)) for u in range(50) for i in rng.choice(60, 9)], "user_id long, item_id long")
    want = sorted(map(tuple, profile_top_k(pairs, items, 6).collect()))
    got = profile_top_k(pairs, items, 6, item_block_bytes=60 * 4 * 8 // 4)
    assert "vec" not in got._jdf.queryExecution().optimizedPlan().toString()  # no vector is joined or shuffled
    assert sorted(map(tuple, got.collect())) == want and len(want) == 300
