"""Word splitting, joins of small tables, components and blocks."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tastebud.llm.arrowtext import class_counts, hashed_counts, slices, split_words
from tastebud.llm.common import join_small, let, prepare, words
from tastebud.llm.components import blocked, connected_components
from tests.llm import brute as B

TEXTS = ["", None, "a", "  lead\ttrail \n", "x\x0by\x0cz\rw", "non breaking  space", "a b  c\n\nd", "été \U0001f600"]


def test_words_of_both_ways_agree_with_the_pattern(spark):
    want = [B.WORD.findall(t or "") for t in TEXTS]
    flat, counts = split_words(pa.array(TEXTS, pa.string()))
    ends = np.cumsum(counts)
    assert [flat.to_pylist()[e - c:e] for e, c in zip(ends, counts)] == want
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r.i: r.w for r in df.select("i", words(F.col("t")).alias("w")).collect()}
    assert [got[i] for i in range(len(TEXTS))] == want


def test_class_counts_and_hashed_counts():
    c = class_counts(pa.array(["Ab1 É", None, ""]))
    assert c["letters"].tolist() == [3, 0, 0] and c["capitals"].tolist() == [2, 0, 0] and c["digits"].tolist() == [1, 0, 0]
    flat, counts = split_words(pa.array(["a b a", "", "b"]))
    per, slot, n = hashed_counts(flat, counts, 1 << 20)
    assert per.tolist() == [2, 0, 1] and sorted(n[:2].tolist()) == [1, 2]


def test_slices_cover_all_rows():
    b = pa.record_batch({"text": ["x" * 10, None, "y" * 500, "", "z"]})
    assert [r for s in slices(b, "text", 100) for r in s.column("text").to_pylist()] == b.column("text").to_pylist()
    assert list(slices(b.slice(0, 0), "text")) == []


def test_let_evaluates_inside(spark):
    df = spark.range(3).select(let(F.col("id") + 1, lambda x: x * x).alias("y"))
    assert [r.y for r in df.collect()] == [1, 4, 9]


def test_join_small_broadcast_and_salted_agree(spark):
    prepare(spark)
    left = spark.createDataFrame([("a", 1)] * 50 + [("b", 2), (None, 3), ("z", 4)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 30), ("b", 20)], "k string, v int")
    for how in ("left", "inner"):
        a = sorted(map(str, join_small(left, right, ["k"], how).collect()))
        b = sorted(map(str, join_small(left, right, ["k"], how, max_broadcast_rows=1, salts=4).collect()))
        assert a == b and len(a) == (53 if how == "left" else 52)


def test_connected_components(spark):
    prepare(spark)
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(500, 560)]
    pairs += [(700, i) for i in range(701, 900)]  # a hot node
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = B.components(1000, pairs)
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {n: root[n] for n in nodes}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_blocks_let_every_pair_of_a_key_meet(spark):
    prepare(spark)
    rows = spark.createDataFrame([("hot", i) for i in range(60)] + [("cold", i) for i in range(100, 105)], "k string, i long")
    cells = {}
    for r in blocked(rows, "k", "i", 16).collect():
        cells.setdefault((r.k, r.bi, r.bj), []).append(r.i)
    met = set()
    for members in cells.values():
        assert len(members) <= 60
        met |= {(a, b) for a in members for b in members if a < b}
    assert met == {(a, b) for s in (range(60), range(100, 105)) for a in s for b in s if a < b}
