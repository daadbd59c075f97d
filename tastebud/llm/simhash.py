"""SimHash near-duplicates with pivot distance tables.

Fingerprints are linked when they differ in at most ``max_bits`` bits.  Rows
meet in cells: 64 bits are cut into six bands, and two fingerprints within 4
bits agree on at least two whole bands, so the 15 pairs of bands find every
link (pivot distances alone concentrate around 32 and cannot form cells).
Inside a cell each fingerprint gets its row of the pivot table, its Hamming
distances to ``N_PIVOTS`` reference fingerprints; a pair whose rows differ by
more than ``max_bits`` in some coordinate cannot be linked (triangle
inequality) and is discarded; survivors are verified bit by bit.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastebud.llm.arrowtext import slices, split_words
from tastebud.llm.common import staged
from tastebud.llm.components import blocked, connected_components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: (offset, width) of the bands; any two whole bands of MAX_BITS + 2 make a cell key.
BANDS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
N_PIVOTS = 16
CELL_ROWS = 4096


def text_fingerprints(texts: pa.Array, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Unsigned 64-bit fingerprints of whole texts (no words: zero)."""
    flat, counts = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    n = len(flat)
    out = np.zeros(len(counts), np.uint64)
    if not n:
        return out
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), flat), " ")[0].as_py().encode()
    lens = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    # the last word of the shingle that starts at each word; short texts are one shingle
    per = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    first_word = np.cumsum(counts) - counts
    shingle_at = np.cumsum(per) - per
    w = np.repeat(first_word - shingle_at, per) + np.arange(per.sum())
    last = w + np.repeat(np.minimum(counts, shingle), per) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[w].tolist(), ends[last].tolist())),
                    np.uint64, len(w))
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = np.flatnonzero(per)
    ones = np.add.reduceat(bits, shingle_at[full], axis=0, dtype=np.int32)
    majority = (2 * ones > per[full, None]).astype(np.uint8)
    out[full] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 carry: bool = False) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) for every row, with ``carry`` also the row as struct ``row``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      *([F.struct("*").alias("row")] if carry else []))
    keep = [c for c in src.columns if c != "text"]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                fp = text_fingerprints(part.column("text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(fp, pa.int64())],
                                                 names=[*keep, "fp"])

    schema = T.StructType([*(src.schema[c] for c in keep), T.StructField("fp", T.LongType())])
    return src.mapInArrow(run, schema)


def pivots(n: int = N_PIVOTS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64)


def link_cells(cell: np.ndarray, fp: np.ndarray, max_bits: int, refs: np.ndarray) -> np.ndarray:
    """Index of a linked representative for every row (its own where it has none).

    ``cell`` is sorted.  Row ``i`` is compared with row ``i + k`` of the same
    cell for k = 1, 2, ...; links found are folded into labels as they come,
    so no pair list outgrows a bounded buffer and rows that are already
    connected are not compared again.
    """
    n = len(fp)
    table = np.stack([np.bitwise_count(fp ^ p) for p in refs], axis=1).astype(np.int8)
    label = np.arange(n)
    new = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    end = np.repeat(np.r_[new[1:], n], np.diff(np.r_[new, n]))
    found, pending, k = [], 0, 1
    left = np.arange(n)

    def fold():
        a, b = (np.concatenate(x) for x in zip(*found))
        while True:
            m = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], m)
            np.minimum.at(label, label[b], m)
            label[:] = label[label]
            if (before == label).all() and (label[a] == label[b]).all():
                return

    while True:
        left = left[left + k < end[left]]
        if not len(left):
            break
        a = left[label[left] != label[left + k]]
        for j in range(table.shape[1]):  # maximum coordinate difference, one pivot after the other
            a = a[np.abs(table[a, j] - table[a + k, j]) <= max_bits]
        a = a[np.bitwise_count(fp[a] ^ fp[a + k]) <= max_bits]
        if len(a):
            found.append((a, a + k))
            pending += len(a)
        if pending > 200_000:
            fold()
            found, pending = [], 0
        k += 1
    if found:
        fold()
    return label


def fingerprint_edges(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``fp`` that connect all links of at most ``max_bits`` bits.

    Only a spanning forest of each cell is returned, not every pair.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the bands find links of at most {MAX_BITS} bits")
    keys = []
    for c, ((o1, w1), (o2, w2)) in enumerate(combinations(BANDS, 2)):
        one = F.shiftrightunsigned("fp", o1).bitwiseAND(F.lit((1 << w1) - 1).cast("long"))
        two = F.shiftrightunsigned("fp", o2).bitwiseAND(F.lit((1 << w2) - 1).cast("long"))
        keys.append(F.shiftleft(F.lit(c).cast("long"), 22) + F.shiftleft(one, 11) + two)
    rows = staged(distinct.select("fp", F.explode(F.array(*keys)).alias("cell")), "simcells")
    rows = blocked(rows, "cell", "fp", CELL_ROWS).withColumn("part", F.xxhash64("cell", "bi", "bj"))
    refs = pivots()

    def run(batches):
        held = None
        for batch in batches:
            got = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "fp")]
            if held is not None:
                got = [np.concatenate(x) for x in zip(held, got)]
            at = np.searchsorted(got[0], got[0][-1]) if len(got[0]) else 0
            held = [x[at:] for x in got]
            if at:
                yield links(got[0][:at], got[1][:at])
        if held is not None and len(held[0]):
            yield links(*held)

    def links(part, fp):
        label = link_cells(part, fp.view(np.uint64), max_bits, refs)
        moved = np.flatnonzero(label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[label[moved]])], names=["a", "b"])

    cells = rows.select("part", "fp").repartition("part").sortWithinPartitions("part")
    return cells.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, carry: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, fp, fingerprint, root, component_id, keeper`` (and ``row`` with ``carry``).

    ``component_id`` is the smallest id reachable by links, ``root`` names the
    component, ``keeper`` is true for exactly one row of each component: its
    smallest id (null ids last, one of them where repeated rows share it).
    Null and empty texts have fingerprint zero and are linked like any other;
    a component of null ids only has a null ``component_id``.
    """
    rows = fingerprints(docs, id_col, text_col, shingle, carry)
    rows = staged(rows.withColumn("rid", F.monotonically_increasing_id()), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    distinct = staged(rows.groupBy("fp").agg(first.alias("first")), "simdistinct")
    edges = fingerprint_edges(distinct.select("fp"), max_bits)
    comp = staged(connected_components(edges), "simcomp")
    linked = distinct.join(comp.withColumnRenamed("node", "fp"), "fp")
    best = linked.groupBy("root").agg(F.min("first").alias("best"))
    linked = staged(linked.select("fp", "root").join(best, "root"), "simlinked")
    whole = distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("best", "first").alias("best"))
    out = rows.join(whole, "fp")
    return out.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "root",
                      F.col("best.doc_id").alias("component_id"), (F.col("rid") == F.col("best.rid")).alias("keeper"),
                      *(["row"] if carry else []))
