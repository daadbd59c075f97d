"""Exact top-K search of one block of items: the scorer inside the tasks of :mod:`topk` and :mod:`topk_bounds`.

The items lie in leaves of alike vectors (halved along the widest principal
axis, unless the caller gives the leaves).  A leaf bounds its scores with a user
by its box on the principal axes and by its ball.  Users are taken in groups of
alike vectors; a group visits leaves from the highest bound down and leaves out
those whose bound is below the K-th score of each of its users.

A visited leaf is multiplied in single precision.  That only selects: an item
that comes within the arithmetic's error and the rounding of a user's K-th
score is scored again in double precision, rounded and ranked.  The K-th score
is that of the leaves before or a lower bound of that of the leaves at hand,
whichever is higher.  So a pair costs one product and two comparisons, few are
scored again, and the rows do not depend on leaves or groups.
"""

from __future__ import annotations

import numpy as np

#: Items of a leaf and users of a group, at most.
LEAF_ITEMS, GROUP_USERS = 256, 128
#: Leaves multiplied at once: few at first, for a K-th score to skip others by, then up to so many items.
FIRST_LEAVES, STEP_ITEMS = 8, 16384
#: Half a unit of the sixth decimal, by which rounding moves a score, twice.
ROUNDING = 1e-6
#: Vectors with larger numbers are selected in double precision.
SINGLE_MAX = 1e15


def round_scores(S: np.ndarray) -> np.ndarray:
    """6 decimals, halves away from zero: the one rounding rule of ranks and emitted scores."""
    return np.copysign(np.floor(np.abs(S) * 1e6 + 0.5) / 1e6, S) + 0.0


def row_norms(M: np.ndarray) -> np.ndarray:
    """Norms by row, 1 for a zero vector."""
    norms = np.linalg.norm(M, axis=1)
    return np.where(norms > 0, norms, 1.0)


def leaves(X: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers of ``X`` in leaves of at most ``size``, halved along the axis on which they vary most."""
    out, stack = [], [np.arange(len(X))]
    while stack:
        rows = stack.pop()
        if len(rows) <= size:
            out.append(np.sort(rows))
            continue
        some = X[rows[::max(1, len(rows) // 4096)]]  # the choice of the axis decides nothing but the speed
        axis = int(np.argmax(np.nan_to_num(some.var(axis=0), posinf=0.0)))
        half = len(rows) // 2
        parts = np.argpartition(X[rows, axis], half)
        stack += [rows[parts[half:]], rows[parts[:half]]]
    return out


class ItemIndex:
    """Items with their leaves; ``ids`` ascend (repeated ids keep their order)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, metric: str, members: list[np.ndarray] | None = None):
        self.sorted_ids = ids
        n, width = vectors.shape
        norms = np.linalg.norm(vectors, axis=1)
        self.reach = float(min(norms.max(initial=0.0), 1.0) if metric == "cosine" else norms.max(initial=0.0))
        self.single = bool(np.isfinite(norms).all()) and norms.max(initial=0.0) < SINGLE_MAX
        divisor = np.where(norms > 0, norms, 1.0) if metric == "cosine" else np.ones(n)
        self.basis = np.eye(width)
        if self.single and n:
            some = vectors[::max(1, n // 65536)] / divisor[::max(1, n // 65536)][:, None]
            self.basis = np.linalg.eigh(some.T @ some)[1][:, ::-1].copy()
        turned = vectors @ self.basis if self.single else vectors.copy()
        turned /= divisor[:, None]
        members = [m for m in (members if members is not None else leaves(turned, LEAF_ITEMS)) if len(m)]
        order = np.concatenate(members) if members else np.zeros(0, np.int64)
        self.starts = np.concatenate([[0], np.cumsum([len(m) for m in members])]).astype(np.int64)
        self.place = np.empty(n, np.int64)
        self.place[order] = np.arange(n)
        self.ids, self.vectors = ids[order], vectors[order]
        self.norms = divisor[order] if metric == "cosine" else None
        self.fast = np.empty((n, width), np.float32 if self.single else np.float64)
        n_leaves = len(members)
        lo, hi, center = (np.zeros((n_leaves, width)) for _ in range(3))
        self.radius = np.zeros(n_leaves)
        for i, m in enumerate(members):
            mine = turned[m]
            self.fast[self.starts[i]:self.starts[i + 1]] = mine
            lo[i], hi[i] = mine.min(axis=0), mine.max(axis=0)
            center[i] = lo[i] / 2 + hi[i] / 2
            self.radius[i] = np.linalg.norm(mine - center[i], axis=1).max()
        with np.errstate(invalid="ignore", over="ignore"):
            half = hi / 2 - lo / 2
            far = np.linalg.norm(center, axis=1) + np.linalg.norm(half, axis=1) + self.radius
        self.far = float(far.max(initial=0.0))
        self.center, self.half = center.T.astype(self.fast.dtype), half.T.astype(self.fast.dtype)

    def positions(self, wanted: np.ndarray, copies: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """``(which of wanted, position)`` of the wanted ids that are items; of a repeated id the first, or all ``copies``."""
        lo, hi = np.searchsorted(self.sorted_ids, wanted), np.searchsorted(self.sorted_ids, wanted, "right")
        n = hi - lo if copies else np.minimum(hi - lo, 1)
        which = np.repeat(np.arange(len(wanted)), n)
        at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return which, self.place[at]

    def scores(self, users: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rounded scores of pairs, in double precision."""
        out = np.empty(len(at))
        for a in range(0, len(at), 65536):
            some = self.vectors[at[a:a + 65536]]
            if self.norms is not None:
                some = some / self.norms[at[a:a + 65536]][:, None]
            out[a:a + 65536] = np.einsum("ij,ij->i", users[a:a + 65536], some)
        return round_scores(out)

    def bounds(self, turned: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, users x leaves; NaN where there is none.

        From the middle of a leaf's box a score rises by at most what the box's
        half widths or the radius about the middle allow.  In the precision of
        ``turned``; its error is added.
        """
        with np.errstate(invalid="ignore", over="ignore"):
            size = np.linalg.norm(turned.astype(np.float64), axis=1)
            more = np.abs(turned) @ self.half.astype(turned.dtype, copy=False)
            reach = size[:, None].astype(turned.dtype) * self.radius.astype(turned.dtype)
            np.minimum(more, reach, out=more)
            more += turned @ self.center.astype(turned.dtype, copy=False)
            # n products and sums, the vectors, their differences and the last sum rounded
            more += ((len(self.center) + 8) * 2.0 ** -23 * size * self.far).astype(turned.dtype)[:, None]
        return more


def _kth_bound(S: np.ndarray, k: int) -> np.ndarray:
    """A lower bound of every row's ``k``-th largest number: the ``k``-th of the maxima of more than ``2 k`` sets of columns."""
    n, m = S.shape
    sets = min(8 * k, m // 4)
    if sets > 2 * k:
        S = S[:, :m // sets * sets].reshape(n, -1, sets).max(axis=1)
    return -np.partition(-S, k - 1, axis=1)[:, k - 1].astype(np.float64)


def _few(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The candidates without those that a row of many has ``k`` better ones for; ``rows`` ascend."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    ends = np.append(starts[1:], len(rows))
    if (ends - starts).max() <= 4 * k:
        return rows, ids, scores
    keep = np.ones(len(rows), bool)
    for a, b in zip(starts, ends):
        if b - a > 4 * k:
            mine = scores[a:b]
            kth = np.partition(mine, b - a - k)[b - a - k]
            keep[a:b] = mine >= kth
            ties = a + np.flatnonzero(mine == kth)
            if len(ties) > k:  # of equal scores the smallest ids
                keep[ties[np.argpartition(ids[ties], k - 1)[k:]]] = False
    return rows[keep], ids[keep], scores[keep]


def _merge(top: np.ndarray, top_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
    """Put candidates into the top lists of their rows: score descending, id ascending."""
    k = top.shape[1]
    touched = np.unique(rows)
    held = np.repeat(touched, k)
    r = np.concatenate([held, rows])
    s, i = np.concatenate([top[touched].ravel(), scores]), np.concatenate([top_ids[touched].ravel(), ids])
    real = s > -np.inf
    r, s, i = r[real], s[real], i[real]
    order = np.lexsort((i, -s, r))
    r, s, i = r[order], s[order], i[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    keep = rank < k
    top[r[keep], rank[keep]], top_ids[r[keep], rank[keep]] = s[keep], i[keep]


def _search(index: ItemIndex, users: np.ndarray, turned: np.ndarray, seen: np.ndarray, top: np.ndarray, top_ids: np.ndarray) -> None:
    """Put the index's items into a group's top lists ``(scores, ids)``, padded with -inf; ``seen``: sorted ``row * items + position``."""
    n, n_leaves, n_items, k = len(users), len(index.radius), len(index.ids), top.shape[1]
    single = index.single and bool(np.isfinite(users).all()) and np.abs(users).max(initial=0.0) < SINGLE_MAX
    left = turned.astype(np.float32) if single else turned
    bounds = index.bounds(left)
    bounds[np.isnan(bounds)] = np.inf
    with np.errstate(invalid="ignore", over="ignore"):
        # of n products and sums in single precision, with both vectors rounded to it: n + 2 half units, and 2 to spare
        error = (users.shape[1] + 4) * 2.0 ** -24 * np.linalg.norm(users, axis=1) * index.reach
    slack = ROUNDING + np.where(np.isfinite(error), error, 0.0)
    best = bounds.max(axis=0)
    order = np.argsort(-best, kind="stable")
    seen_row, seen_at = np.divmod(seen, n_items)
    seen_leaf = np.searchsorted(index.starts, seen_at, "right") - 1
    place, sizes = np.empty(n, np.int64), np.diff(index.starts)
    at, step = 0, FIRST_LEAVES
    while at < n_leaves:
        low = top[:, k - 1] - slack
        if best[order[at]] < low.min():
            break
        take = order[at:at + step]
        at, step = at + step, min(2 * step, max(1, STEP_ITEMS * n_leaves // n_items))
        wanted = bounds[:, take] >= low[:, None]
        take, some = take[wanted.any(axis=0)], np.nonzero(wanted.any(axis=1))[0]
        if not len(take):
            continue
        first = np.cumsum(sizes[take]) - sizes[take]
        where = np.arange(sizes[take].sum()) + np.repeat(index.starts[take] - first, sizes[take])
        right = index.fast[where]
        with np.errstate(invalid="ignore", over="ignore"):
            S = left[some] @ (right if single else right.astype(np.float64)).T
            cut = low[some]
            if S.shape[1] > 4 * k:
                # the K-th single score of the unseen here will do as well, less both scores' errors
                if len(seen):
                    column, place[:] = np.full(n_leaves, -1), -1
                    column[take], place[some] = first, np.arange(len(some))
                    here = np.flatnonzero((column[seen_leaf] >= 0) & (place[seen_row] >= 0))
                    inside = seen_at[here] - index.starts[seen_leaf[here]]
                    S[place[seen_row[here]], column[seen_leaf[here]] + inside] = -np.inf
                kth = _kth_bound(S, k) - 2 * slack[some]
                cut = np.where(np.isfinite(kth), np.maximum(cut, kth), cut)
            # without a K-th score the cut is -inf: everything but NaN is a candidate
            flat = np.flatnonzero(S >= cut.astype(S.dtype)[:, None])
        rows, cols = np.divmod(flat, S.shape[1])
        rows, pos = some[rows], where[cols]
        if len(seen) and len(rows):
            key = rows * n_items + pos
            new = seen[np.minimum(np.searchsorted(seen, key), len(seen) - 1)] != key
            rows, pos = rows[new], pos[new]
        if len(rows):
            with np.errstate(invalid="ignore", over="ignore"):
                scores = index.scores(users[rows], pos)
            kth = top[rows, k - 1]
            ids = index.ids[pos]
            ok = (scores > -np.inf) & ((scores > kth) | (scores == kth) & (ids <= top_ids[rows, k - 1]) | (kth == -np.inf))
            if ok.any():
                _merge(top, top_ids, *_few(rows[ok], ids[ok], scores[ok], k))


def empty_lists(n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Top lists ``(scores, ids)`` of ``n`` users before any item."""
    return np.full((n, k), -np.inf), np.zeros((n, k), np.int64)


def _by_row(srow: np.ndarray, spos: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seen positions in the order of their rows, and where a row's begin and end."""
    order = np.argsort(srow, kind="stable")
    srow = srow[order]
    return spos[order], np.searchsorted(srow, np.arange(n)), np.searchsorted(srow, np.arange(n), "right")


def _seen_keys(group: np.ndarray, n_items: int, spos: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([i * n_items + spos[lo[u]:hi[u]] for i, u in enumerate(group)]))


def _turned(index: ItemIndex, users: np.ndarray) -> np.ndarray:
    with np.errstate(invalid="ignore", over="ignore"):
        return users @ index.basis if index.single else users


def emitted(user_ids: np.ndarray, top: np.ndarray, top_ids: np.ndarray):
    """``(users, items, scores, ranks)`` arrays of top lists."""
    ok = np.isfinite(top)
    ranks = np.broadcast_to(np.arange(1, top.shape[1] + 1, dtype=np.int32), top.shape)
    return np.broadcast_to(user_ids[:, None], top.shape)[ok], top_ids[ok], top[ok], ranks[ok]


def ranked(index: ItemIndex, user_ids: np.ndarray, users: np.ndarray, srow: np.ndarray, spos: np.ndarray, k: int):
    """Yield ``(users, items, scores, ranks)`` arrays; seen pairs are rows of ``users`` with positions in ``index``."""
    n_items = len(index.ids)
    if not n_items or not len(user_ids) or k < 1:
        return
    turned = _turned(index, users)
    spos, lo, hi = _by_row(srow, spos, len(user_ids))
    k = min(k, n_items)
    for group in leaves(turned, GROUP_USERS):
        top, top_ids = empty_lists(len(group), k)
        _search(index, users[group], turned[group], _seen_keys(group, n_items, spos, lo, hi), top, top_ids)
        yield emitted(user_ids[group], top, top_ids)


def search_next(index: ItemIndex, users: np.ndarray, srow: np.ndarray, spos: np.ndarray, top: np.ndarray, top_ids: np.ndarray) -> None:
    """Put the items of one more index into the users' top lists, whose K-th scores leave out its leaves from the start."""
    n_items = len(index.ids)
    if not n_items or not len(users) or not top.shape[1]:
        return
    turned = _turned(index, users)
    spos, lo, hi = _by_row(srow, spos, len(users))
    for group in leaves(turned, GROUP_USERS):
        own, own_ids = top[group], top_ids[group]
        _search(index, users[group], turned[group], _seen_keys(group, n_items, spos, lo, hi), own, own_ids)
        top[group], top_ids[group] = own, own_ids
