"""Vector code compression: integer codebooks of vector parts, by per-dimension value dictionaries.

A vector's components become integers and are cut into parts; a part's code is
the index of the nearest entry of its codebook.  Integers repeat: for every
dimension the distinct ones of a batch form a dictionary, and the squared
differences of each to all entries are tabulated once.  A part's distances to
all entries are then gathers by dictionary code and additions, in whole numbers.

A round is one pass over the integers (a stage output): tasks add up the parts
of every entry and count them, one row per entry leaves a task, and the driver
gets the sums of at most ``parts * entries`` entries.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastebud.llm.common import join_small, staged

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components beyond this (after scaling) are set to it, so that the errors of 512 of them, and sums of 2 ** 36 rows, fit in 64 bits.
MAX_INT = 1 << 26
#: Rows whose distances are held at once.
CHUNK = 4096


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` components, all of them finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == dim) & ~bad, F.lit(False))


def integers(vector: Column) -> Column:
    """``floor(SCALE * x)`` of every component."""
    return F.transform(vector, lambda x: F.greatest(F.lit(-MAX_INT), F.least(F.lit(MAX_INT), F.floor(x * F.lit(float(SCALE))))))


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part of the rows ``x`` (the first of equal ones) and its squared distance.

    ``books`` has the shape parts x entries x components of a part.
    """
    parts, entries, width = books.shape
    near, dist = np.empty((len(x), parts), np.int64), np.empty((len(x), parts), np.int64)
    for p in range(parts):
        tables, codes = [], []
        for d in range(width):
            values, code = np.unique(x[:, p * width + d], return_inverse=True)  # the dimension's dictionary
            tables.append((values[:, None] - books[p, :, d]) ** 2)
            codes.append(code)
        for a in range(0, len(x), CHUNK):
            total = tables[0][codes[0][a:a + CHUNK]]
            for table, code in zip(tables[1:], codes[1:]):
                total += table[code[a:a + CHUNK]]
            near[a:a + CHUNK, p] = total.argmin(axis=1)
            dist[a:a + CHUNK, p] = total.min(axis=1)
    return near, dist


def _rows(batch: pa.RecordBatch, column: str, dim: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def vector_integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    parts: int = PARTS) -> tuple[DataFrame, int]:
    """``vec_id, label, ints`` (a stage output) of the usable vectors, and their number of components.

    That number is the length of the usable vector with the smallest id (nulls
    last, then by content) among those whose length is a multiple of ``parts``;
    vectors of other lengths are left out, as are null ones and those that hold
    nulls or numbers that are not finite.
    """
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"))
    fits = (F.size("v") > 0) & (F.size("v") % parts == 0) & usable(F.col("v"), F.size("v"))
    first = v.where(fits).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).select(F.size("v")).collect()
    dim = first[0][0] if first else parts
    return staged(v.where(usable(F.col("v"), dim)).select("vec_id", "label", integers(F.col("v")).alias("ints")), "vecints"), dim


def fit_codebooks(ints: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x components), from the parts of the ``entries`` smallest ids, after ``rounds`` rounds.

    Of rows with equal ids the one with smaller integers comes first, so the
    result does not depend on the rows' order.  A table of fewer rows has fewer
    entries; an empty one has none.
    """
    seeds = ints.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    books = np.array([r.ints for r in seeds], np.int64).reshape(len(seeds), parts, dim // parts).transpose(1, 0, 2).copy()
    schema = "part int, entry int, n long, sums array<long>"
    for _ in range(rounds if len(seeds) else 0):
        def partial(batches, books=books):
            width = books.shape[2]
            n, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
            for batch in batches:
                x = _rows(batch, "ints", dim)
                near, _ = nearest(x, books)
                for p in range(parts):
                    n[p] += np.bincount(near[:, p], minlength=books.shape[1])
                    np.add.at(sums[p], near[:, p], x[:, p * width:(p + 1) * width])
            part, entry = np.nonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]),
                 pa.ListArray.from_arrays(np.arange(0, len(part) * width + 1, width).astype(np.int32),
                                          pa.array(sums[part, entry].ravel()))], names=["part", "entry", "n", "sums"])

        got = ints.select("ints").mapInArrow(partial, schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *(F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(dim // parts)))
        for r in got.collect():  # a row per entry at most
            books[r.part, r.entry] = [r[f"s{j}"] // r.n for j in range(dim // parts)]
    return books


def codebooks_text(books: np.ndarray) -> str:
    """All entries' components by part, entry and position, joined by commas."""
    return ",".join(map(str, books.ravel().tolist()))


def encode_vectors(ints: DataFrame, dim: int, books: np.ndarray) -> DataFrame:
    """``vec_id, label, codes, error``: the entry of every part, and the squared distances summed over the parts."""
    schema = T.StructType([ints.schema["vec_id"], ints.schema["label"], T.StructField("codes", T.ArrayType(T.IntegerType())),
                           T.StructField("error", T.LongType())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                near, dist = nearest(_rows(batch, "ints", dim), books)
                ends = np.arange(0, near.size + 1, near.shape[1]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"),
                     pa.ListArray.from_arrays(ends, pa.array(near.astype(np.int32).ravel())), pa.array(dist.sum(axis=1))],
                    names=["vec_id", "label", "codes", "error"])

    return ints.mapInArrow(run, schema)


def compress_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, codes, error, label_error`` of every usable vector, and the codebooks.

    ``label_error`` adds the errors of all vectors of the label (null labels
    together; null if the sum leaves 64 bits).  See :func:`vector_integers` for the vectors that are left out;
    repeated rows are rows of their own, ties go to the lower entry, other
    columns are ignored, and an empty table gives no rows and no entries.
    """
    ints, dim = vector_integers(vectors, id_col, vector_col, label_col, parts)
    books = fit_codebooks(ints, dim, parts, entries, rounds)
    coded = staged(encode_vectors(ints, dim, books), "veccodes")
    by_label = staged(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "labelerrors")
    return join_small(coded, by_label, ["label"], "left"), books


def code_text(codes: Column) -> Column:
    """Two lowercase hexadecimal digits of every code."""
    return F.concat_ws("", F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")))


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(codebooks_text(books).encode()).hexdigest()
