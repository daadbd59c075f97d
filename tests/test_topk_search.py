"""The search inside a block of items: the rows of brute force, and far less work than all pairs in double precision."""

import time

import numpy as np
import pytest

from tastebud.operators.topk_search import ItemIndex, leaves, ranked, round_scores, row_norms


def _brute(users, items, ids, seen, k, metric):
    items = items / row_norms(items)[:, None] if metric == "cosine" else items
    out = []
    for u, v in enumerate(users):
        s = round_scores(np.einsum("j,ij->i", v, items))
        free = [i for i in np.lexsort((ids, -s)) if (u, i) not in seen][:k]
        out += [(u, ids[i], s[i], r + 1) for r, i in enumerate(free)]
    return out


def _rows(index, users, k, seen=()):
    r, c = (np.array([p[x] for p in sorted(seen)], np.int64) for x in (0, 1))
    parts = list(ranked(index, np.arange(len(users)), users, r, index.place[c], k))
    return sorted(zip(*(np.concatenate([p[x] for p in parts]).tolist() for x in range(4))), key=lambda x: (x[0], x[3]))


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("kind", ["spread", "clusters", "equal", "huge"])
def test_rows_of_brute_force(metric, kind):
    rng = np.random.default_rng(7)
    items, users = rng.normal(size=(3000, 6)), rng.normal(size=(300, 6))
    if kind == "clusters":
        items = rng.normal(size=(9, 6))[rng.integers(0, 9, 3000)] + 1e-4 * items
    if kind == "equal":  # ties beyond any K, and zero vectors
        items, users = np.round(items), np.round(users)
        items[10:40], users[3] = 0.0, 0.0
    if kind == "huge":
        items, users = items * 1e9, users * 1e9
    users = users / row_norms(users)[:, None] if metric == "cosine" else users
    ids = np.sort(rng.choice(10 ** 6, 3000, replace=False))
    seen = {(int(u), int(i)) for u in range(0, 300, 2) for i in rng.choice(3000, 40)} | {(8, i) for i in range(2990)}
    for k in (1, 20, 4000):
        some = users if k < 4000 else users[:20]
        want = _brute(some, items, ids, seen, k, metric)
        got = _rows(ItemIndex(ids, items, metric), some, k, [p for p in seen if p[0] < len(some)])
        if kind != "huge":
            assert got == want
        else:  # doubles have no sixth decimal there
            assert [x[0] for x in got] == [x[0] for x in want]
            assert np.allclose([x[2] for x in got], [x[2] for x in want], rtol=1e-12)


def test_repeated_ids_and_numbers_that_are_none():
    items = np.array([[1.0, 0], [1, 0], [0, 1], [np.nan, 1], [np.inf, 0]])
    index = ItemIndex(np.array([4, 4, 5, 6, 7]), items, "dot")
    assert [r[1:] for r in _rows(index, np.array([[1.0, 2.0]]), 5)] == [(5, 2.0, 2), (4, 1.0, 3), (4, 1.0, 4)]
    which, at = index.positions(np.array([4, 9, 5]))
    assert which.tolist() == [0, 2] and index.ids[at].tolist() == [4, 5]
    which, at = index.positions(np.array([4, 9, 5]), copies=True)
    assert which.tolist() == [0, 0, 2] and len(set(at.tolist())) == 3
    assert sorted(np.concatenate(leaves(np.zeros((1000, 2)), 64)).tolist()) == list(range(1000))


def test_a_pair_costs_a_fraction_of_scoring_and_sorting_it():
    rng = np.random.default_rng(1)
    items, users = rng.normal(size=(100_000, 16)) * np.linspace(1, 0.2, 16), rng.normal(size=(1024, 16))
    index = ItemIndex(np.arange(len(items)), items, "dot")
    t0 = time.process_time()
    assert len(_rows(index, users, 20)) == 20 * len(users)
    searched = time.process_time() - t0
    t0 = time.process_time()
    for a in range(0, 128, 64):  # as all pairs were scored before
        R = round_scores(users[a:a + 64] @ items.T)
        np.argpartition(-R, 19, axis=1)
    assert searched < (time.process_time() - t0) * 8 / 2


def test_few_pairs_are_scored_again_for_users_with_seen_items(monkeypatch):
    rng = np.random.default_rng(3)
    turn = rng.uniform(0, 2 * np.pi, (60_000, 1)) + 0.9 * np.arange(8)  # crowded: scores differ by less than 1e-6 at the top
    items, users = np.cos(turn), np.sin(rng.uniform(0, 2 * np.pi, (512, 1)) + 1.1 * np.arange(8))
    index, scored, scores = ItemIndex(np.arange(len(items)), items, "dot"), [], ItemIndex.scores
    monkeypatch.setattr(ItemIndex, "scores", lambda self, users, at: (scored.append(len(at)), scores(self, users, at))[1])
    seen = {(u, int(i)) for u in range(len(users)) for i in rng.choice(len(items), 20)}
    seen |= {(0, int(i)) for i in np.argsort(-items @ users[0])[:300]}  # the best and more are seen
    got = _rows(index, users, 20, seen)
    assert sum(scored) < 600 * len(users)
    some = {(u, i) for u, i in seen if u < 8}
    assert [r for r in got if r[0] < 8] == _brute(users[:8], items, np.arange(len(items)), some, 20, "dot")


def test_bounds_of_single_precision_are_above_all_scores():
    rng = np.random.default_rng(5)
    for scale, metric in ((1.0, "cosine"), (1e-3, "dot"), (1e6, "dot")):
        X, U = rng.normal(3.0, 1.0, (900, 12)) * scale, rng.normal(3.0, 1.0, (60, 12))
        index = ItemIndex(np.arange(900), X, metric, [np.arange(a, a + 3) for a in range(0, 900, 3)])
        turned = (U @ index.basis).astype(np.float32)
        got = index.bounds(turned)
        assert got.dtype == np.float32
        scores = U @ (X / row_norms(X)[:, None] if metric == "cosine" else X).T
        assert (got.astype(np.float64) >= scores.reshape(60, 300, 3).max(axis=2)).all()
