"""ALS planted structure and the autoencoder's gradients and training."""

import numpy as np
from pyspark.sql import functions as F

from tastebud.operators import autoencoder as AE
from tastebud.operators.als import als_recommend, fit_als


def test_als_ranks_in_block_items_first(spark):
    # two communities: users 0-19 use items 0-9, users 20-39 use items 10-19; each user misses 3 items
    rows = []
    for u in range(40):
        block = range(0, 10) if u < 20 else range(10, 20)
        rows += [(u, i, 1.0) for i in block if (i + u) % 10 not in (0, 1, 2)]
    train = spark.createDataFrame(rows, "user_id long, item_id long, play double")
    fit = fit_als(train, rank=2, max_iter=20, reg=0.01, alpha=5.0, seed=1)  # rank = planted communities
    recs = als_recommend(fit, train, k=3).collect()
    seen = {(u, i) for u, i, _ in rows}
    assert len(recs) == 40 * 3
    for r in recs:
        assert (r.user_id, r.item_id) not in seen
        assert (r.user_id < 20) == (r.item_id < 10)


def test_als_large_ids_are_indexed(spark):
    big = 2 ** 40
    rows = [(big + u, big + i, 1.0) for u in range(6) for i in range(6) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user_id long, item_id long, play double")
    fit = fit_als(train, rank=2, max_iter=3, seed=1)
    assert fit.users is not None
    recs = als_recommend(fit, train, k=2).collect()
    assert all(r.user_id >= big and r.item_id >= big for r in recs)


def test_autoencoder_gradients_match_finite_differences():
    rng = np.random.RandomState(0)
    X = rng.randn(7, 3)
    p = AE.init_params(3, hidden=5, latent=2, seed=0)
    loss, grads = AE._loss_and_grads(p, X)
    w, b = p.layers[1]
    eps = 1e-6
    w[0, 1] += eps
    lp, _ = AE._loss_and_grads(p, X)
    w[0, 1] -= 2 * eps
    lm, _ = AE._loss_and_grads(p, X)
    assert abs((lp - lm) / (2 * eps) - grads[1][0][0, 1]) < 1e-6


def _probe(spark, n, width, parts, seed=1):
    rng = np.random.RandomState(seed)
    rows = [(i, rng.randn(width).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "item_id long, vec array<double>").repartition(parts)


def _batches(df, seed, epoch, steps):
    """The rows of each step as the operator deals them."""
    dealt = F.pmod(F.xxhash64(F.lit(seed), F.lit(epoch), F.col("item_id")), F.lit(steps))
    rows = df.withColumn("b", dealt).collect()
    return [np.array([r.vec for r in rows if r.b == b]) for b in range(steps)]


def test_autoencoder_training_does_not_depend_on_partitions(spark):
    p0 = AE.init_params(4, hidden=16, latent=3, seed=0)
    fits = [AE.train(_probe(spark, 200, 4, parts), 4, epochs=2, lr=1e-2, steps_per_epoch=4, params=p0, tasks=tasks)
            for parts, tasks in ((1, 0), (16, 0), (4, 1), (1, 4), (16, 8), (4, None))]  # jobs by step, barrier tasks
    got = [p.flat() for p, _ in fits]
    assert all(np.abs(got[0] - x).max() < 1e-9 for x in got[1:])
    assert all(np.allclose(fits[0][1], losses) for _, losses in fits[1:])
    # the same steps, one after the other in numpy
    theta, m, v, t = p0.flat(), 0.0, 0.0, 0
    for epoch in range(2):
        for X in _batches(_probe(spark, 200, 4, 1), 42, epoch, 4):
            _, grads = AE._loss_and_grads(AE.AeParams.from_flat(theta, p0.dims), X)
            g = np.concatenate([np.concatenate([gw.ravel(), gb]) for gw, gb in grads])
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta = theta - 1e-2 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    assert np.abs(got[0] - theta).max() < 1e-9


def test_a_lost_barrier_task_restarts_its_epoch_only(spark, tmp_path, monkeypatch):
    """The second epoch fails once in one of its tasks; the parameters are those of an undisturbed training."""
    p0 = AE.init_params(4, hidden=8, latent=3, seed=0)
    data = _probe(spark, 300, 4, 4)
    want = AE.train(data, 4, epochs=3, lr=1e-2, steps_per_epoch=4, params=p0, tasks=4)[0].flat()
    plain, epochs, flag = AE._epoch_by_barrier, [], str(tmp_path / "failed")

    class Failing(AE.Adam):
        def update(self, g, lr):
            import os

            from pyspark import TaskContext
            if TaskContext.get().partitionId() == 2 and self.t == 5 and not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("lost")
            super().update(g, lr)

    def epoch(*a):
        epochs.append(a[3].t)
        return plain(*a)
    monkeypatch.setattr(AE, "_epoch_by_barrier", epoch)
    monkeypatch.setattr(AE, "Adam", Failing)
    try:
        got = AE.train(data, 4, epochs=3, lr=1e-2, steps_per_epoch=4, params=p0, tasks=4)[0].flat()
        assert np.abs(got - want).max() < 1e-9
    except Exception as e:  # a local master does not retry tasks: the epoch before it is done, the failing one is not
        assert "lost" in str(e) and epochs == [0, 4]


def test_autoencoder_learns_as_well_in_many_partitions(spark):
    data = _probe(spark, 2000, 6, 8)
    p0 = AE.init_params(6, hidden=32, latent=4, seed=0)
    before = AE.dataset_loss(data, p0)
    p1, losses = AE.train(data, 6, epochs=3, lr=1e-2, steps_per_epoch=16, params=p0)
    after = AE.dataset_loss(data, p1)
    assert len(losses) == 3 and before > 0.95 and after < 0.75
    z = AE.encode(data, p1).first().vec
    assert len(z) == 4 and min(z) >= 0.0


def test_als_text_ids(spark):
    rows = [(f"u{u}", f"i{i}", 1.0) for u in range(6) for i in range(6) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user_id string, item_id string, play double")
    recs = als_recommend(fit_als(train, rank=2, max_iter=3, seed=1), train, k=2).collect()
    seen = {(u, i) for u, i, _ in rows}
    assert len(recs) == 12 and all((r.user_id, r.item_id) not in seen for r in recs)


def test_queries_recommend_with_a_fully_trained_autoencoder(spark, monkeypatch):
    import inspect

    import pytest
    from tastebud.operators import autoencoder
    from tastebud.plans import queries
    args = inspect.signature(autoencoder.train)

    class Trained(Exception):
        pass

    def train(*a, **kw):
        got = args.bind(*a, **kw)
        got.apply_defaults()
        raise Trained(got.arguments["epochs"], got.arguments["steps_per_epoch"])

    queries.PL.clear_stage_outputs()
    monkeypatch.setattr(queries.AE, "train", train)
    for name in ("als_recs", "model_recs", "train_set", "test_set", "catalog", "catalog_vectors"):
        monkeypatch.setattr(queries.PL, name, lambda *a, **kw: None)
    monkeypatch.setattr(queries.AE, "training_input", lambda *a: None)
    for query in (queries.q_ae_topk, queries.q_evaluation_report, queries.q_als_quality_checks):
        with pytest.raises(Trained) as got:
            query(spark, "/root/testdata/sf0.001")
        assert got.value.args == (autoencoder.EPOCHS, autoencoder.STEPS_PER_EPOCH) == (50, 16)


def test_given_tables_get_the_reference_models(spark, monkeypatch):
    import inspect

    import pytest
    from tastebud.operators import als, autoencoder
    from tastebud.operators.catalog import CatalogSpec
    from tastebud.plans import pipeline
    args = {k: v.default for k, v in inspect.signature(pipeline.recommend).parameters.items()}
    assert (args["p"].als_rank, args["p"].als_iter, args["k"]) == (als.DEFAULT_RANK, als.DEFAULT_ITER, als.DEFAULT_K) == (128, 50, 500)
    assert (args["epochs"], args["steps_per_epoch"]) == (autoencoder.EPOCHS, autoencoder.STEPS_PER_EPOCH) == (50, 16)

    class Fitted(Exception):
        pass

    def fit(train, **kw):
        raise Fitted(kw["rank"], kw["max_iter"], kw["reg"])

    monkeypatch.setattr(pipeline.ALS, "fit_als", fit)
    raw = spark.createDataFrame([(f"t{i}", f"n{i}", "['a']", float(i), 60.0, i) for i in range(6)],
                                "id string, name string, artists string, energy double, popularity double, o int")
    inter = spark.createDataFrame([(u, f"t{j}") for u in range(4) for j in range(5)], "user_id long, item_id string")
    spec = CatalogSpec(feature_cols=["energy"], id_col="id", order_col="o", min_support=1)
    with pytest.raises(Fitted) as got:
        pipeline.recommend(raw, inter, spec)
    assert got.value.args == (128, 50, als.DEFAULT_REG)


def test_pipeline_over_given_tables(spark):
    from tastebud.operators.catalog import CatalogSpec
    from tastebud.plans.pipeline import Params, recommend
    raw = spark.createDataFrame(
        [(f"t{i}", f"n{i}", f"['a{i % 2}', 'x']", float(i % 7), float(i % 5), 60.0 if i < 28 else 10.0, 0) for i in range(30)],
        "id string, name string, artists string, energy double, tempo double, popularity double, o int")
    inter = spark.createDataFrame([(u, f"t{(u * 3 + j) % 30}") for u in range(12) for j in range(8)],
                                  "user_id long, item_id string")
    spec = CatalogSpec(feature_cols=["energy", "tempo", "valence"], id_col="id", order_col="o", min_support=5)
    out = recommend(raw, inter, spec, Params(als_rank=2, als_iter=2), k=5, epochs=1, steps_per_epoch=2)
    assert out.catalog.count() == 28 and out.board.count() == 6
    r = out.removed.first()
    assert r.n_train == out.train.count() and r.n_removed == r.n_train - r.n_in_catalog > 0
    assert {x.model for x in out.recs.select("model").distinct().collect()} == {"als", "autoencoder"}
    assert out.recs.join(out.train, ["user_id", "item_id"]).count() == 0


def test_tasks_train_together_only_beyond_the_rows_of_one(spark):
    from tastebud.operators import autoencoder as AE
    few = spark.range(150_000)  # exchanging sums between tasks took more than three times as long
    assert AE.barrier_tasks(few, 6) == 1
    assert AE.barrier_tasks(few, AE.MAX_TASK_BYTES // 8 // 100_000) > 1  # rows too wide for one task
    assert AE.barrier_tasks(spark.range(AE.ROWS_ALONE + 1), 6) > 1


def test_rows_beyond_one_task_are_trained_on_by_jobs_that_do_not_wait(spark, monkeypatch):
    p0 = AE.init_params(4, hidden=8, latent=3, seed=0)
    data = _probe(spark, 300, 4, 4)
    want = AE.train(data, 4, epochs=2, lr=1e-2, steps_per_epoch=4, params=p0, tasks=4)
    monkeypatch.setattr(AE, "ROWS_ALONE", 100)
    monkeypatch.setattr(AE, "ROWS_PER_TASK", 50)
    monkeypatch.setattr(AE, "_epoch_by_barrier", None)  # tasks that wait a second for each exchange
    got = AE.train(data, 4, epochs=2, lr=1e-2, steps_per_epoch=4, params=p0)
    assert np.abs(got[0].flat() - want[0].flat()).max() < 1e-9 and np.allclose(got[1], want[1])
