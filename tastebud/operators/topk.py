"""Exact all-pairs top-K scoring (users x items) without a cross join.

Two ways, chosen by the measured size of the item vectors; both order by the
same rounded scores, so they give the same result.

*Item vectors of up to ``item_block_bytes``* are one broadcast block and the
user rows stream past it (``mapInArrow``): no user is shuffled for scoring and
an executor holds one copy of the items.  Up to ``MAX_PIECES`` times as many are
hashed into so many broadcast pieces, fetched by the driver one at a time.  A
task holds one of them at a time too: some 65 000 users pass all pieces, their
top lists go on from one to the next, then the next users do.  Nothing but the
users' rows is shuffled and a user's rows are not copied.

*Still larger catalogues* are hashed into item blocks.  Each user row is copied once
per item block and each item row once per user block; both sides are co-grouped
on ``(user_block, item_block)``, an equi-key shuffle, and every group scores one
block pair.  Seen pairs travel unreplicated.  Each group emits at most K rows
per user and ``row_number() <= K`` merges them.

Order: the score rounded to 6 decimals (half away from zero, once, in the
block) descending, then item id ascending; the rounded score is what is
emitted.  Cosine of a zero vector is 0.0.  A block is searched by
:mod:`tastebud.operators.topk_search`, which leaves out items by bounds and
holds a few MB of scores at a time.  Ids that are not whole numbers are replaced by
dense indices in id order and joined back.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastebud.functions.hashing import block_of
from tastebud.operators.ranking import dense_index, long_ids, whole_groups
from tastebud.operators.topk_search import ItemIndex, emitted, empty_lists, ranked, row_norms, search_next
from tastebud.operators.vectors import mean_vectors
from tastebud.session import materialize
from tastebud.sources.io import require_columns

DEFAULT_BLOCK_ROWS = 131072
DEFAULT_ITEM_BLOCK_BYTES = 256 * 1024 * 1024
MIN_BLOCK_ROWS = 512
#: Broadcast pieces of ``item_block_bytes`` that a catalogue may have.
MAX_PIECES = 16
#: Users searched together: Arrow batches hold some hundreds, among which few are alike.  The bytes bound their lists.
GATHER_USERS, GATHER_BYTES = 65536, 64 * 1024 * 1024


def _block_count(n: int, block_rows: int, parallelism: int) -> int:
    if n <= 0:
        return 1
    return max(math.ceil(n / block_rows), min(parallelism, math.ceil(n / MIN_BLOCK_ROWS)))


def _matrix(table, vec_col: str) -> np.ndarray:
    """Arrow list<double> column -> dense (rows x dim) matrix without per-row objects."""
    import pyarrow as pa
    col = table.column(vec_col).combine_chunks() if isinstance(table.column(vec_col), pa.ChunkedArray) \
        else table.column(vec_col)
    n = len(col)
    if n == 0:
        return np.zeros((0, 0))
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, len(flat) // n)


def _unit_rows(M: np.ndarray) -> np.ndarray:
    return M / row_norms(M)[:, None]


def _make_scorer(k: int, metric: str, user_col: str, item_col: str, vec_col: str):
    import pyarrow as pa
    import pyarrow.compute as pc

    schema = pa.schema([(user_col, pa.int64()), (item_col, pa.int64()), ("score", pa.float64()),
                        ("rank", pa.int32())])

    def score_block(left: "pa.Table", right: "pa.Table") -> "pa.Table":
        if left.num_rows == 0 or right.num_rows == 0:
            return schema.empty_table()
        items = right.filter(pc.equal(right.column("_kind"), 0))
        if items.num_rows == 0:
            return schema.empty_table()
        item_ids = items.column(item_col).to_numpy().astype(np.int64)
        order = np.argsort(item_ids, kind="stable")
        item_ids = item_ids[order]
        index = ItemIndex(item_ids, _matrix(items, vec_col)[order], metric)
        user_ids = left.column(user_col).to_numpy().astype(np.int64)
        U = _matrix(left, vec_col)
        U = _unit_rows(U) if metric == "cosine" else U
        seen = right.filter(pc.equal(right.column("_kind"), 1))
        srow = pd.Index(user_ids).get_indexer(seen.column(user_col).to_numpy().astype(np.int64))
        scol = pd.Index(item_ids).get_indexer(seen.column(item_col).to_numpy().astype(np.int64))
        keep = (srow >= 0) & (scol >= 0)
        parts = [pa.table(dict(zip(schema.names, x)), schema=schema)
                 for x in ranked(index, user_ids, U, srow[keep], index.place[scol[keep]], k)]
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return score_block


def _whole(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.IntegralType)


def _by_index(frames: list[DataFrame], col: str, idx: str) -> tuple[DataFrame, list[DataFrame]]:
    """Dense index of the ids in all ``frames`` and the frames with the id replaced by it."""
    ids = frames[0].select(col)
    for f in frames[1:]:
        ids = ids.unionByName(f.select(col))
    index = dense_index(ids, col, idx)
    return index, [f.join(index, col).drop(col).withColumnRenamed(idx, col) for f in frames]


def _vector_bytes(items: DataFrame, vec_col: str) -> int:
    """Bytes of the vectors by their number and width: measured before anything is fetched."""
    st = items.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec_col)).alias("d")).first()
    return (st["n"] or 0) * 8 * max(1, st["d"] or 1)


def _fetched(items: DataFrame, item_col: str, vec_col: str) -> tuple[np.ndarray, np.ndarray]:
    t = items.select(F.col(item_col).cast("long").alias(item_col), F.col(vec_col).cast("array<double>").alias(vec_col)).toArrow()
    ids = t.column(item_col).to_numpy().astype(np.int64)
    order = np.argsort(ids, kind="stable")
    M = _matrix(t, vec_col)
    return ids[order], M[order] if len(M) else np.zeros((0, 1))


def item_block(items: DataFrame, item_col: str, vec_col: str, item_block_bytes: int):
    """``(sorted ids, matrix)`` if the vectors take at most ``item_block_bytes``, else ``None``."""
    return _fetched(items, item_col, vec_col) if _vector_bytes(items, vec_col) <= item_block_bytes else None


def item_pieces(items: DataFrame, metric: str, item_col: str, vec_col: str, item_block_bytes: int) -> list | None:
    """Broadcast ``ItemIndex`` pieces of at most about ``item_block_bytes``, ``None`` beyond ``MAX_PIECES`` of them."""
    n = max(1, math.ceil(_vector_bytes(items, vec_col) / item_block_bytes))
    if n > MAX_PIECES:
        return None
    parts = [items]
    if n > 1:  # written apart, so that a piece is read alone
        rows = items.select(item_col, vec_col).withColumn("_piece", block_of(item_col, n))
        rows = materialize(rows, ("_piece",), tag="itempieces")
        parts = [rows.where(F.col("_piece") == F.lit(i)) for i in range(n)]
    sc = items.sparkSession.sparkContext
    return [sc.broadcast(ItemIndex(*_fetched(part, item_col, vec_col), metric)) for part in parts]


def _in_turn(held: list):
    """The pieces one after the other; of several the task keeps none (a broadcast's file is read again on its next turn)."""
    for piece in held:
        yield piece.value
        if len(held) > 1 and getattr(piece, "_path", None):
            vars(piece).pop("_value", None)


def _users_at_once(held: list, k: int) -> int:
    """Users searched together: their top lists are held while they pass several pieces."""
    return GATHER_USERS if len(held) == 1 else max(1, min(GATHER_USERS, GATHER_BYTES // (16 * max(1, k))))


def _top_rows(held: list, user_ids: np.ndarray, users: np.ndarray, srow: np.ndarray, seen: np.ndarray, k: int,
              names: list[str], copies: bool = False):
    """Arrow batches of the users' top lists over all pieces; ``seen``: item ids of the rows ``srow`` of ``users``."""
    import pyarrow as pa

    def found():
        if len(held) == 1:
            index = held[0].value
            which, at = index.positions(seen, copies)
            yield from ranked(index, user_ids, users, srow[which], at, k)
            return
        top, top_ids = empty_lists(len(user_ids), k)
        for index in _in_turn(held):
            which, at = index.positions(seen, copies)
            search_next(index, users, srow[which], at, top, top_ids)
            del index  # before the next one is read
        for a in range(0, len(user_ids), 4096):
            yield emitted(user_ids[a:a + 4096], top[a:a + 4096], top_ids[a:a + 4096])
    for u, i, sc, r in found():
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(i), pa.array(sc), pa.array(r)], names=names)


def _gathered(batches, rows: int = GATHER_USERS, size: int = GATHER_BYTES):
    """The rows of Arrow batches in batches of ``rows`` or a little more, sooner if they take ``size`` bytes."""
    import pyarrow as pa
    held, n, taken = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n, taken = n + batch.num_rows, taken + batch.nbytes
        if n >= rows or taken >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n, taken = [], 0, 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _user_tasks(df: DataFrame) -> int:
    """One scoring task per core: all end together, where one more would run alone after them, and users alike meet."""
    return df.sparkSession.sparkContext.defaultParallelism


def _packed_lists(column) -> tuple[np.ndarray, np.ndarray, "object"]:
    """Flat values and row numbers of an Arrow list<struct> column (null: empty)."""
    import pyarrow.compute as pc
    lens = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lens)), lens), lens, column.flatten()


def _item_lists(pairs: DataFrame, user_col: str, item_col: str) -> DataFrame:
    """Every user's distinct items with their counts: ``(user, seen array<struct<i, c>>)``."""
    return (pairs.groupBy(user_col, item_col).agg(F.count(F.lit(1)).alias("c"))
            .groupBy(user_col).agg(F.collect_list(F.struct(F.col(item_col).cast("long").alias("i"), "c")).alias("seen")))


def profile_vectors(pairs: DataFrame, items: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                    vec_col: str = "vec", chunk_rows: int = 512, item_block_bytes: int = DEFAULT_ITEM_BLOCK_BYTES) -> DataFrame:
    """``(user, vec)``: the mean of a user's item vectors, repeated pairs weighing in (whole-number item ids).

    Formed in the item block, so that only ids are shuffled; beyond the block's
    size, or with repeated item ids, by an aggregate over the joined vectors.
    """
    block = item_block(items, item_col, vec_col, item_block_bytes)
    if block is None or (np.diff(block[0]) == 0).any():
        return mean_vectors(pairs.join(items, item_col), user_col, vec_col, vec_col)
    held = pairs.sparkSession.sparkContext.broadcast(block)
    known = pairs.join(items.select(item_col), item_col, "left_semi")

    def run(batches):
        import pyarrow as pa
        ids, M = held.value
        for batch in batches:
            for first in range(0, batch.num_rows, chunk_rows):
                part = batch.slice(first, chunk_rows)
                _, lens, flat = _packed_lists(part.column("seen"))
                times = flat.field("c").to_numpy(zero_copy_only=False).astype(np.float64)
                col = np.searchsorted(ids, flat.field("i").to_numpy(zero_copy_only=False))
                start = np.cumsum(lens) - lens
                means = np.add.reduceat(M[col] * times[:, None], start, axis=0) / np.add.reduceat(times, start)[:, None]
                ends = pa.array(np.arange(0, means.size + 1, means.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(user_col), pa.ListArray.from_arrays(ends, pa.array(means.ravel()))],
                                                 names=[user_col, vec_col])

    kind = pairs.schema[user_col].dataType.simpleString()
    return _item_lists(known, user_col, item_col).mapInArrow(run, f"{user_col} {kind}, {vec_col} array<double>")


def profile_top_k(pairs: DataFrame, items: DataFrame, k: int, user_col: str = "user_id", item_col: str = "item_id",
                  vec_col: str = "vec", chunk_rows: int = 512,
                  item_block_bytes: int = DEFAULT_ITEM_BLOCK_BYTES) -> DataFrame | None:
    """Cosine top-``k`` unseen items for users given by their items; ``None`` beyond the size of the item pieces.

    ``pairs`` are the users' items (all in ``items``, whole-number ids).  The
    profile, the mean of a user's item vectors with repeated pairs weighing in,
    is formed in the item pieces: only ids are shuffled, once by (user, item) and
    once by user, where they are sorted and not gathered into lists.  A user has
    at most a row per item of the catalogue.
    """
    held = item_pieces(items, "cosine", item_col, vec_col, item_block_bytes)
    if held is None:
        return None
    rows = (pairs.groupBy(user_col, item_col).agg(F.count(F.lit(1)).alias("c"))
            .select(F.col(user_col).cast("long").alias(user_col), F.col(item_col).cast("long").alias("i"), "c")
            .repartition(_user_tasks(pairs), user_col).sortWithinPartitions(user_col))
    names, at_once = [user_col, item_col, "score", "rank"], _users_at_once(held, k)

    def run(batches):
        for table in whole_groups(batches, user_col, at_once, GATHER_BYTES):
            ids, items = long_ids(table.column(user_col)), table.column("i").to_numpy()
            order = np.lexsort((items, ids))  # sums are formed in the order of the items
            ids, items, times = ids[order], items[order], table.column("c").to_numpy()[order].astype(np.float64)
            start = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            row = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(ids))))
            profiles = None
            for index in _in_turn(held):
                which, at = index.positions(items)
                profiles = np.zeros((len(start), index.vectors.shape[1])) if profiles is None else profiles
                mine = row[which]
                for first in range(0, len(start), chunk_rows):
                    a, b = np.searchsorted(mine, [first, first + chunk_rows])
                    if a < b:
                        own = np.flatnonzero(np.diff(mine[a:b], prepend=-1))
                        profiles[mine[a:b][own]] += np.add.reduceat(index.vectors[at[a:b]] * times[which[a:b], None], own, axis=0)
                del index  # before the next one is read
            profiles = _unit_rows(profiles / np.add.reduceat(times, start)[:, None])
            yield from _top_rows(held, ids[start], profiles, row, items, k, names)

    return rows.mapInArrow(run, f"{user_col} long, {item_col} long, score double, rank int")


def with_seen(users: DataFrame, seen: DataFrame | None, user_col: str, item_col: str, vec_col: str) -> DataFrame:
    """User rows with their vectors and ``seen array<struct<i>>``, the distinct items of their pairs, dealt to the scoring tasks."""
    tasks = _user_tasks(users)
    left = (users.select(F.col(user_col).cast("long").alias(user_col), F.col(vec_col).cast("array<double>").alias(vec_col))
            .repartition(tasks, user_col))
    if seen is None:
        return left.withColumn("seen", F.lit(None).cast("array<struct<i:bigint>>"))
    lists = (seen.select(F.col(user_col).cast("long").alias(user_col), F.col(item_col).cast("long").alias("i"))
             .distinct().repartition(tasks, user_col).groupBy(user_col).agg(F.collect_list(F.struct("i")).alias("seen")))
    return left.join(lists, user_col, "left")


def stream_top_k(users: DataFrame, held: list, k: int, seen: DataFrame | None, metric: str, user_col: str,
                 item_col: str, vec_col: str, copies: bool = False) -> DataFrame:
    """User rows with vectors and seen lists stream past broadcast item pieces; ``copies`` as in ``ItemIndex.positions``."""
    left = with_seen(users, seen, user_col, item_col, vec_col)
    names, at_once = [user_col, item_col, "score", "rank"], _users_at_once(held, k)

    def run(batches):
        for batch in _gathered(batches, at_once):
            ids = batch.column(user_col).to_numpy(zero_copy_only=False).astype(np.int64)
            U = _matrix(batch, vec_col)
            U = _unit_rows(U) if metric == "cosine" else U
            row, _, flat = _packed_lists(batch.column("seen"))
            yield from _top_rows(held, ids, U, row, flat.field("i").to_numpy(zero_copy_only=False), k, names, copies)

    return left.mapInArrow(run, f"{user_col} long, {item_col} long, score double, rank int")


def top_k_scores(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None,
                 metric: str = "cosine", user_col: str = "user_id", item_col: str = "item_id",
                 vec_col: str = "vec", block_rows: int = DEFAULT_BLOCK_ROWS,
                 item_block_bytes: int = DEFAULT_ITEM_BLOCK_BYTES,
                 n_user_blocks: int | None = None, n_item_blocks: int | None = None) -> DataFrame:
    """Top-``k`` items per user by ``metric`` ("cosine" or "dot"), seen pairs excluded.

    Returns ``(user_id, item_id, score, rank)`` with ``score`` rounded to 6
    decimals.  ``n_item_blocks`` asks for the co-grouped way with so many blocks.
    """
    require_columns(users, [user_col, vec_col], "users")
    require_columns(items, [item_col, vec_col], "items")
    if not _whole(users, user_col) or not _whole(items, item_col):
        kw = dict(metric=metric, user_col=user_col, item_col=item_col, vec_col=vec_col, block_rows=block_rows,
                  item_block_bytes=item_block_bytes, n_user_blocks=n_user_blocks, n_item_blocks=n_item_blocks)
        frames = [users] + ([seen.select(user_col, item_col)] if seen is not None else [])
        u_index, u = _by_index(frames, user_col, "_uidx")
        frames = [items] + ([u[1]] if seen is not None else [])
        i_index, i = _by_index(frames, item_col, "_iidx")
        top = top_k_scores(u[0], i[0], k, i[1] if seen is not None else None, **kw)
        return (top.withColumnRenamed(user_col, "_uidx").withColumnRenamed(item_col, "_iidx")
                .join(u_index, "_uidx").join(i_index, "_iidx").select(user_col, item_col, "score", "rank"))
    if n_item_blocks is None:
        held = item_pieces(items, metric, item_col, vec_col, item_block_bytes)
        if held is not None:
            return stream_top_k(users, held, k, seen, metric, user_col, item_col, vec_col)
        st = items.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec_col)).alias("d")).first()
        n_item_blocks = math.ceil(st["n"] / max(MIN_BLOCK_ROWS, item_block_bytes // (8 * max(1, st["d"] or 1))))
    if n_user_blocks is None:
        n_user_blocks = _block_count(users.count(), block_rows, users.sparkSession.sparkContext.defaultParallelism)

    left = (users.select(F.col(user_col).cast("long").alias(user_col), F.col(vec_col))
            .withColumn("_ub", block_of(user_col, n_user_blocks))
            .withColumn("_ib", F.explode(F.sequence(F.lit(0), F.lit(n_item_blocks - 1)))))
    right = (items.select(F.col(item_col).cast("long").alias(item_col), F.col(vec_col))
             .withColumn("_ib", block_of(item_col, n_item_blocks))
             .withColumn("_ub", F.explode(F.sequence(F.lit(0), F.lit(n_user_blocks - 1))))
             .withColumn("_kind", F.lit(0))
             .withColumn(user_col, F.lit(None).cast("long")))
    if seen is not None:
        # Distinct pairs (map-side combined) bound a group's seen list by the
        # block's users x items, however many repeated rows one user has.
        s = (seen.select(F.col(user_col).cast("long").alias(user_col), F.col(item_col).cast("long").alias(item_col))
             .distinct()
             .withColumn("_ub", block_of(user_col, n_user_blocks))
             .withColumn("_ib", block_of(item_col, n_item_blocks))
             .withColumn("_kind", F.lit(1))
             .withColumn(vec_col, F.lit(None).cast(items.schema[vec_col].dataType)))
        right = right.unionByName(s)

    schema = f"{user_col} long, {item_col} long, score double, rank int"
    scored = (left.groupBy("_ub", "_ib")
              .cogroup(right.groupBy("_ub", "_ib"))
              .applyInArrow(_make_scorer(k, metric, user_col, item_col, vec_col), schema))
    w = Window.partitionBy(user_col).orderBy(F.col("score").desc(), F.col(item_col))
    return (scored.withColumn("rank", F.row_number().over(w).cast("int"))
            .where(F.col("rank") <= F.lit(k)))
