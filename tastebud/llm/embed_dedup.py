"""Embedding near-duplicates by randomly rotated binary codes.

A unit vector is rotated by a random orthogonal matrix and its code is the
signs; with the code goes the correction factor ``f``, the inner product of the
vector and its code.  ``<code, q> / f`` is an unbiased estimate of ``<x, q>``
whose error is at most ``EPS * sqrt((1 - f^2) / f^2 / (d - 1))`` but with
negligible probability.  The other side ``q`` is the rotated vector in whole
numbers of one byte with its step and the length of its rounding error.

Only codes, bytes and factors travel to the cells where vectors meet.  A pair
whose upper bound reaches the threshold is bounded again from the bytes of both
sides, where the rounding errors are hard limits: most pairs are then decided,
and only the rest fetch their vectors and are recomputed in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastebud.llm.common import join_small, staged
from tastebud.llm.components import connected_components

MIN_COSINE = 0.93
#: Width of the confidence bound; a link is lost only if both directions of a pair miss it.
EPS = 5.0
BLOCK_ROWS = 8192
#: Rows of the left and right side of a block pair that are compared at a time.
CHUNK, TILE = 512, 2048
#: Reference vectors in all, and steps of the angle to the nearest one that order a label's vectors into blocks.
N_PIVOTS, ANGLE_STEPS = 16, 64
#: Slack for floating point in angles and in bounds.
SLACK_ANGLE, SLACK = 1e-5, 1e-9


def rotation(dim: int, seed: int = 42) -> np.ndarray:
    """Random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes_of(unit: np.ndarray, rot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction factors of unit vectors."""
    turned = unit @ rot
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def signs(codes: np.ndarray, dim: int) -> np.ndarray:
    return (np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))


def whole_numbers(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors as signed bytes, with the step of each and the length of its rounding error."""
    step = np.abs(turned).max(axis=1) / 127
    q = np.rint(turned / step[:, None]).astype(np.int8)
    return q, step, np.linalg.norm(turned - q * step[:, None], axis=1)


def upper_bounds(code_rows, f_rows, q_cols, step_cols, err_cols, dim: int) -> np.ndarray:
    """Estimate plus confidence bound of every (coded row, rounded column) inner product."""
    est = (signs(code_rows, dim) @ q_cols.T.astype(np.float32)) * step_cols.astype(np.float32)
    conf = EPS * np.sqrt(np.maximum(1 - f_rows ** 2, 0) / f_rows ** 2 / max(dim - 1, 1))
    return (est + err_cols.astype(np.float32)) / f_rows[:, None] + conf[:, None]


class Coded:
    """Rows of a cell without their vectors: codes, factors, bytes, steps and rounding errors."""

    def __init__(self, code, f, q, step, err):
        self.code, self.f, self.q, self.step, self.err = code, f, q, step, err

    def __len__(self):
        return len(self.f)

    def __getitem__(self, at) -> "Coded":
        return Coded(self.code[at], self.f[at], self.q[at], self.step[at], self.err[at])


def may_link(a: Coded, b: Coded, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that the codes cannot exclude, in one direction or the other."""
    dim = a.q.shape[1]
    maybe = upper_bounds(a.code, a.f, b.q, b.step, b.err, dim) >= min_cosine
    maybe |= (upper_bounds(b.code, b.f, a.q, a.step, a.err, dim) >= min_cosine).T
    return np.nonzero(maybe)


def decide(a: Coded, b: Coded, i: np.ndarray, j: np.ndarray, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the pairs that are linked for certain and of those that need their vectors."""
    sure, open_ = np.zeros(len(i), bool), np.zeros(len(i), bool)
    for p in range(0, len(i), 1 << 15):
        at = slice(p, p + (1 << 15))
        x, y = i[at], j[at]
        dot = np.einsum("ij,ij->i", a.q[x], b.q[y], dtype=np.float64) * a.step[x] * b.step[y]
        err = a.err[x] + (1 + a.err[x]) * b.err[y] + SLACK
        sure[at] = dot - err >= min_cosine
        open_[at] = (dot + err >= min_cosine) & ~sure[at]
    return sure, open_


class Forest:
    """Union-find over rows 0 .. n-1 with the smaller row as root, fed with arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[i], label[j]
            apart = x != y
            if not apart.any():
                return
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            m = np.minimum(x, y)
            np.minimum.at(label, x, m)
            np.minimum.at(label, y, m)
            label[:] = label[label]
            while (label != label[label]).any():
                label[:] = label[label]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _bytes(column, dtype) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def unit_vectors(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def chained(unit: np.ndarray) -> np.ndarray:
    """The vectors in an order where each is followed by the nearest of the rest."""
    left, order = list(range(1, len(unit))), [0]
    while left:
        order.append(left.pop(int(np.argmax(unit[left] @ unit[order[-1]]))))
    return unit[order]


def angle_cells(coded: DataFrame, cap: int, min_cosine: float) -> DataFrame:
    """Copies of the rows with the cells ``(group, bi, bj)`` where they meet the rows of their group; ``blk`` is their own block.

    A group of at most ``cap`` rows is one cell.  A larger one is ordered by its
    nearest pivot and the angle to it, from counts by angle step, and cut into
    blocks of about ``cap`` rows; rows of one step are dealt by hash.  Two
    blocks meet unless their angles to some pivot are further apart than the
    angle of ``min_cosine``, which by the triangle inequality excludes a link.
    """
    rows = coded.drop("unit")
    group = Window.partitionBy("group")  # at most pivots times steps rows
    steps = coded.groupBy("group", "near", "step_no").agg(F.count(F.lit(1)).alias("c")).select(
        "group", "near", "step_no", "c", F.sum("c").over(group).alias("n"),
        F.coalesce(F.sum("c").over(group.orderBy("near", "step_no").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("before")).where(F.col("n") > cap).drop("n")
    share = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 20)) / (1 << 20)
    rows = join_small(rows, staged(steps, "anglesteps"), ["group", "near", "step_no"])
    rows = rows.withColumn("blk", F.floor((F.col("before") + share * F.col("c")) / cap).cast("int")).drop("c", "before")
    at = [F.get("angles", F.lit(r)) for r in range(N_PIVOTS)]
    limits = staged(rows.where("blk IS NOT NULL").groupBy("group", "blk").agg(
        F.array(*[F.min(x) for x in at]).alias("lo"), F.array(*[F.max(x) for x in at]).alias("hi")), "anglelimits")
    other = limits.select("group", F.col("blk").alias("blk2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    reach = float(np.arccos(np.clip(min_cosine, -1, 1))) + SLACK_ANGLE
    apart = F.exists(F.concat(F.zip_with("lo", "hi2", lambda x, y: x - y), F.zip_with("lo2", "hi", lambda x, y: x - y)),
                     lambda gap: gap > reach)
    pairs = limits.join(other, "group").where("blk <= blk2").where(~F.coalesce(apart, F.lit(False)))
    pairs = staged(pairs.select("group", F.col("blk").alias("bi"), F.col("blk2").alias("bj")), "blockpairs")
    cell = F.struct("bi", "bj").alias("cell")
    meets = pairs.select("group", F.col("bi").alias("blk"), cell).unionByName(
        pairs.where("bi < bj").select("group", F.col("bj").alias("blk"), cell))
    meets = staged(meets.groupBy("group", "blk").agg(F.collect_list("cell").alias("cells")), "blockcells")
    rows = join_small(rows, meets, ["group", "blk"])
    alone = F.array(F.struct(F.lit(0).alias("bi"), F.lit(0).alias("bj")))
    return rows.withColumn("cell", F.explode(F.coalesce("cells", alone))).select(
        "group", "cell.bi", "cell.bj", F.coalesce("blk", F.lit(0)).alias("blk"),
        "node", "m", "code", "f", "q", "step", "err")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 min_cosine: float = MIN_COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row; rows are compared when their labels are equal.

    Null labels and vectors that are null, empty, zero or hold nulls or
    non-finite numbers link with nothing, as do vectors of different lengths.
    Equal vectors of a label are one class of copies, compared once and counted
    with its size; an empty table gives an empty result, columns other than
    the three named are not read.  ``component_id`` is the smallest id reachable (null ids
    last), ``kept`` whether it is the row's own; repeated ids are rows of their own.
    """
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad
                        & F.exists("v", lambda x: x != 0), F.lit(False))
    # 128 hashed bits name a class; -0.0 and 0.0 are equal numbers
    plain = F.transform("v", lambda x: x + F.lit(0.0))
    v = v.withColumn("class", F.when(usable, F.struct(F.xxhash64("label", plain).alias("a"),
                                                      F.xxhash64(plain, "label", F.lit(1)).alias("b"))))
    v = staged(v.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    copies = v.where("class IS NOT NULL").groupBy("class").agg(
        F.count(F.lit(1)).alias("m"), F.min("rid").alias("node"),
        F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id")).alias("first"))
    copies = staged(copies, "classes")
    reps = copies.join(v.select(F.col("rid").alias("node"), "label", "v"), "node").select(
        "node", "m", "v", F.concat_ws(":", F.size("v").cast("string"), F.col("label").cast("string")).alias("group"))

    # reference vectors for the angles: a bounded number, whatever the input
    refs = [np.array(r.v) for r in reps.orderBy(F.xxhash64("node"), "node").select("v").limit(N_PIVOTS).collect()]
    pivots = {len(x): chained(unit_vectors(np.stack([y for y in refs if len(y) == len(x)]))) for x in refs}

    def encode(batches):
        for batch in batches:
            lists = batch.column("v")
            dims = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                unit = unit_vectors(_matrix(part.column("v"), int(dim)))
                rot = rotation(int(dim))
                code, f = codes_of(unit, rot)
                q, step, err = whole_numbers(unit @ rot)
                angles = np.arccos(np.clip(unit @ pivots.get(int(dim), np.zeros((0, dim))).T, -1, 1))
                p = angles.shape[1]
                near = angles.argmin(axis=1) if p else np.zeros(len(unit), np.int64)
                step_no = (angles.min(axis=1) * (ANGLE_STEPS / np.pi)).astype(np.int32) if p else near.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("m"), part.column("group"),
                     pa.ListArray.from_arrays(np.arange(0, unit.size + 1, dim).astype(np.int32), pa.array(unit.ravel())),
                     pa.array([c.tobytes() for c in code], pa.binary()), pa.array(f),
                     pa.array([c.tobytes() for c in q], pa.binary()), pa.array(step), pa.array(err),
                     pa.ListArray.from_arrays(np.arange(len(unit) + 1, dtype=np.int32) * p, pa.array(angles.ravel())),
                     pa.array(near.astype(np.int32)), pa.array(step_no)],
                    names=["node", "m", "group", "unit", "code", "f", "q", "step", "err", "angles", "near", "step_no"])

    coded = staged(reps.mapInArrow(
        encode, "node long, m long, group string, unit array<double>, code binary, f double, q binary, step double, "
                "err double, angles array<double>, near int, step_no int"), "codes")
    cells = angle_cells(coded, BLOCK_ROWS, min_cosine)
    chunk_rows, tile_rows = CHUNK, TILE

    def compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        group, bi, bj = (k.as_py() for k in key)
        node, m, blk = (table.column(c).to_numpy() for c in ("node", "m", "blk"))
        rows = Coded(_bytes(table.column("code"), np.uint8), table.column("f").to_numpy(),
                     _bytes(table.column("q"), np.int8), *(table.column(c).to_numpy() for c in ("step", "err")))
        left = np.flatnonzero(blk == bi)
        right = left if bi == bj else np.flatnonzero(blk == bj)
        links, forest = np.zeros(len(node), np.int64), Forest(len(node))

        def result(at, links, to, chunk=None, maybe=None):
            n = len(at)
            return pa.RecordBatch.from_arrays(
                [pa.array([group] * n, pa.string()), pa.array([bi] * n, pa.int32()), pa.array([bj] * n, pa.int32()),
                 pa.array([chunk] * n, pa.int32()), pa.array(node[at]), pa.array(links, pa.int64()),
                 pa.array(to, pa.int64()), pa.array([None] * n if maybe is None else maybe, pa.list_(pa.int64()))],
                names=["group", "bi", "bj", "chunk", "node", "links", "to", "maybe"])

        for chunk, s in enumerate(range(0, len(left), chunk_rows)):
            a = left[s:s + chunk_rows]
            undecided = []
            for t in range(s // tile_rows * tile_rows if bi == bj else 0, len(right), tile_rows):
                b = right[t:t + tile_rows]
                one, two = rows[a], rows[b]
                i, j = may_link(one, two, min_cosine)
                if bi == bj:  # within a block every pair once
                    later = b[j] > a[i]
                    i, j = i[later], j[later]
                sure, open_ = decide(one, two, i, j, min_cosine)
                x, y = a[i[sure]], b[j[sure]]
                links += np.bincount(x, weights=m[y], minlength=len(node)).astype(np.int64)
                links += np.bincount(y, weights=m[x], minlength=len(node)).astype(np.int64)
                forest.add(x, y)
                undecided.append((a[i[open_]], b[j[open_]]))
            x, y = (np.concatenate(side) for side in zip(*undecided))
            if len(x):
                order = np.argsort(x, kind="stable")
                at, first = np.unique(x[order], return_index=True)
                lists = pa.ListArray.from_arrays(np.append(first, len(x)).astype(np.int32), pa.array(node[y[order]]))
                none = np.zeros(len(at), np.int64)
                yield result(at, none, node[at], chunk, lists)
        hit = np.flatnonzero(links)
        yield result(hit, links[hit], node[forest.label[hit]])

    found = cells.groupBy("group", "bi", "bj").applyInArrow(
        compare, "group string, bi int, bj int, chunk int, node long, links long, to long, maybe array<long>")
    found = staged(found, "links")

    # what the bounds leave open: the vectors of a chunk's rows and of their partners, in double precision
    chunk_key = ["group", "bi", "bj", "chunk"]
    open_rows = found.where("maybe IS NOT NULL").select(*chunk_key, "node", "maybe")
    partners = open_rows.select(*chunk_key, F.explode("maybe").alias("node")).distinct().withColumn(
        "maybe", F.lit(None).cast("array<long>"))
    wanted = open_rows.unionByName(partners).join(coded.select("node", "m", "unit"), "node")

    def exact(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("maybe").is_valid().to_numpy()
        node, m = table.column("node").to_numpy(), table.column("m").to_numpy()
        unit = _matrix(table.column("unit").combine_chunks(), len(table.column("unit")[0]))
        rows, at = np.unique(node, return_index=True)  # a row may ask and be a partner
        links, forest = np.zeros(len(rows), np.int64), Forest(len(rows))
        for k in np.flatnonzero(asks):
            j = np.searchsorted(rows, table.column("maybe")[int(k)].values.to_numpy())
            j = j[np.einsum("ij,j->i", unit[at[j]], unit[k]) >= min_cosine]
            i = np.searchsorted(rows, node[k])
            links[i] += m[at[j]].sum()
            links[j] += m[k]
            forest.add(np.full(len(j), i), j)
        hit = np.flatnonzero(links)
        return pa.table({"node": rows[hit], "links": links[hit], "to": rows[forest.label[hit]]})

    exact_links = staged(wanted.groupBy(*chunk_key).applyInArrow(exact, "node long, links long, to long"), "exactlinks")
    found = found.where("maybe IS NULL").select("node", "links", "to").unionByName(exact_links)
    comp = staged(connected_components(found.select(F.col("node").alias("a"), F.col("to").alias("b"))), "veccomp")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = copies.join(links, "node", "left").join(comp, "node", "left").select(
        "class", "m", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"), "first")
    classes = staged(classes, "classlinks")
    best = classes.groupBy("root").agg(F.min("first").alias("best"))
    classes = classes.join(best, "root").select("class", "m", "links", "best")
    out = v.join(classes, "class", "left")
    own = F.col("m").isNull()
    return out.select(
        "vec_id", F.when(own, F.lit(0)).otherwise(F.col("links") + F.col("m") - 1).cast("long").alias("n_links"),
        F.when(own, F.col("vec_id")).otherwise(F.col("best.vec_id")).alias("component_id")).withColumn(
            "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("vec_id").isNull()
                               & F.col("component_id").isNull()))
