"""Vector codes against a plain version in whole numbers."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from tastebud.llm import code_books
from tastebud.llm.common import prepare


def plain(rows, parts, entries, rounds):
    """``rows`` of (id, vector, label), all usable: codes, errors, books."""
    ints = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in rows]
    w = len(ints[0][1]) // parts
    seeds = sorted(ints, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[s[1][p * w:p * w + w] for s in seeds] for p in range(parts)]

    def near(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * w:p * w + w], e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            group = {}
            for _, v, _ in ints:
                group.setdefault(near(p, v)[1], []).append(v[p * w:p * w + w])
            new.append([[sum(c) // len(group[k]) for c in zip(*group[k])] if k in group else e for k, e in enumerate(books[p])])
        books = new
    out = []
    for i, v, g in ints:
        got = [near(p, v) for p in range(parts)]
        out.append((i, [k for _, k in got], sum(d for d, _ in got), g))
    total = {}
    for *_, e, g in out:
        total[g] = total.get(g, 0) + e
    return [(i, c, e, total[g]) for i, c, e, g in out], books


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    return [(int(i) if i % 11 else None, [float(x) for x in rng.normal(size=dim).round(2)], int(i % 3) if i % 7 else None)
            for i in range(n)]


def test_codes_equal_the_plain_version(spark):
    prepare(spark)
    rows = vectors(300, 12, 1)
    rows += rows[:20] + [(1, rows[0][1], 5), (1, rows[1][1], 5)]  # repeated rows and ids
    odd = [(900, None, 1), (901, [], 1), (902, [1.0, None] + [0.0] * 10, 1), (903, [float("nan")] * 12, 1),
           (904, [float("inf")] * 12, 1), (905, [1.0] * 8, 1)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows + odd],
                               "vec_id long, embedding array<double>, label int, error int, codes string").repartition(5)
    for parts, entries, rounds in ((4, 16, 2), (6, 500, 1), (1, 3, 0)):
        got, books = code_books.compress_vectors(df, parts=parts, entries=entries, rounds=rounds)
        want, plain_books = plain(rows, parts, entries, rounds)
        assert sorted(map(str, ((r.vec_id, r.codes, r.error, r.label_error) for r in got.collect()))) == sorted(map(str, want))
        assert books.tolist() == plain_books
    text = ",".join(str(x) for p in plain_books for e in p for x in e)
    assert code_books.codebooks_sha256(books) == hashlib.sha256(text.encode()).hexdigest()


def test_empty_tables_and_huge_components(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, [1e300] * 16, 1), (2, [-1e300] * 16, 1)], "vec_id long, embedding array<double>, label int")
    got, books = code_books.compress_vectors(df)
    assert [r.error for r in got.collect()] == [0, 0] and np.abs(books).max() == code_books.MAX_INT
    got, books = code_books.compress_vectors(df.where("vec_id < 0"))
    assert got.count() == 0 and books.size == 0
    assert code_books.codebooks_sha256(books) == hashlib.sha256(b"").hexdigest()


def test_nearest_takes_the_first_of_equal_entries():
    x = np.array([[0, 0], [5, 5]])
    books = np.array([[[1, 0], [0, 1], [5, 6], [5, 6]]])
    near, dist = code_books.nearest(x, books)
    assert near[:, 0].tolist() == [0, 2] and dist[:, 0].tolist() == [1, 1]


def test_code_text(spark):
    df = spark.createDataFrame([([0, 15, 16, 255],)], "c array<int>")
    assert df.select(code_books.code_text(F.col("c"))).first()[0] == "000f10ff"
