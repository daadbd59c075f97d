"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

``P(grade <= k) = sigmoid(theta_k - w . x)`` with one weight vector for all
ordered thresholds.  Expected severity is the sum of ``P(grade >= k)``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastebud.llm.arrowtext import segment_sum, slices, split_words, word_codes
from tastebud.llm.common import staged

DIMS = 1 << 22
#: Features are whole words and beginnings of words of these lengths.
PREFIXES = (3, 4, 5, 6, 7)
_BASE = np.uint64(0x9E3779B97F4A7C15)
GRADES = 3
#: Labelled documents used for training, at most about this many of each kind (chosen by hash).
TRAIN_TOXIC, TRAIN_CLEAN = 15_000, 30_000
#: Tasks that count features; each holds two counters per hashed feature.
COUNT_TASKS = 64
FLAG_FROM = 0.5
#: Features are kept if their log-odds are at least so many standard errors from zero.
MIN_Z = 2.5
_SIGMOID = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _words(texts: pa.Array):
    """Lower-case words without the punctuation around them."""
    flat, counts = split_words(pc.utf8_lower(pc.fill_null(texts, "")))
    return pc.utf8_trim(flat, "\"'.,;:!?()[]{}#*$%&|<>-_~"), counts


def _slots(dictionary: pa.Array) -> np.ndarray:
    """Hashed features of distinct words (words x features); -1 where a word is too short for a prefix."""
    digest = xxhash.xxh32_intdigest
    n, longest = len(dictionary), max(PREFIXES)
    out = np.full((n, 1 + len(PREFIXES)), -1, np.int64)
    out[:, 0] = np.fromiter((digest(w) % DIMS if w else -1 for w in dictionary.to_pylist()), np.int64, n)
    lens = np.minimum(pc.utf8_length(dictionary).to_numpy(zero_copy_only=False).astype(np.int64), longest)
    heads = "".join(pc.utf8_slice_codeunits(dictionary, 0, longest).to_pylist())
    codes = np.zeros((n, longest), np.uint64)
    codes[np.arange(longest)[None, :] < lens[:, None]] = np.frombuffer(heads.encode("utf-32-le"), np.uint32)
    h = np.zeros(n, np.uint64)
    for k in range(1, longest + 1):
        h = (h + codes[:, k - 1] + np.uint64(k)) * _BASE
        if k in PREFIXES:
            out[:, 1 + PREFIXES.index(k)] = np.where(lens >= k, (h >> np.uint64(40)) % np.uint64(DIMS), -1).astype(np.int64)
    return out


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(words per text, features per text, feature, words with it)`` of whole texts."""
    flat, counts = _words(texts)
    codes, dictionary = word_codes(flat)
    doc = np.repeat(np.arange(len(counts)), counts)
    size = max(1, len(dictionary))
    pair, times = np.unique(doc * size + codes, return_counts=True)
    slots = _slots(dictionary)[pair % size] if len(pair) else np.zeros((0, 1), np.int64)
    ok = slots >= 0
    key = ((pair // size)[:, None] * DIMS + slots)[ok]
    key, inverse = np.unique(key, return_inverse=True)
    n = np.bincount(inverse, weights=np.broadcast_to(times[:, None], slots.shape)[ok], minlength=len(key))
    return counts, np.bincount(key // DIMS, minlength=len(counts)), key % DIMS, n.astype(np.int64)


@dataclass
class SeverityModel:
    """``slots``: kept features in ascending order; ``lift``: their log-odds; ``weights`` and ``thresholds``."""

    slots: np.ndarray
    lift: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """``P(grade >= k)`` for k = 1 .. GRADES."""
        return _SIGMOID(score[:, None] - self.thresholds[None, :])

    def scores(self, texts: pa.Array) -> np.ndarray:
        counts, per, slot, n = _features(texts)
        if not len(self.slots):
            return np.full(len(counts), -1e9)
        at = np.minimum(np.searchsorted(self.slots, slot), len(self.slots) - 1)
        hit = self.slots[at] == slot
        return segment_sum(np.where(hit, self.lift[at] * self.weights[at] * np.log2(1 + n), 0.0), per)


def fit_ordinal(per, column, value, grade, n_columns: int, steps: int = 300, rate: float = 0.05,
                l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by full-batch Adam on the ordinal likelihood.

    Thresholds are a first value and positive steps, so their order holds by
    construction; documents of each class have the same total weight.
    """
    row = np.repeat(np.arange(len(grade)), per)
    par = np.zeros(n_columns + GRADES)
    par[n_columns] = 1.0
    kinds = np.bincount(np.minimum(grade, 1), minlength=2)
    weight = (1 / np.maximum(kinds, 1))[np.minimum(grade, 1)] / 2
    m1, m2 = np.zeros_like(par), np.zeros_like(par)
    k = np.arange(1, GRADES + 1)
    for t in range(1, steps + 1):
        w, raw = par[:n_columns], par[n_columns:]
        theta = raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:]))))
        z = segment_sum(w[column] * value, per)
        up = _SIGMOID(z[:, None] - theta[None, :])  # P(grade >= k)
        full = np.concatenate([np.ones((len(z), 1)), up, np.zeros((len(z), 1))], axis=1)
        at = np.arange(len(z))
        p = np.maximum(full[at, grade] - full[at, grade + 1], 1e-12)
        slope = up * (1 - up)
        d = np.concatenate([np.zeros((len(z), 1)), slope, np.zeros((len(z), 1))], axis=1)
        gz = -weight * (d[at, grade] - d[at, grade + 1]) / p
        gt = np.zeros(GRADES)
        for j in k:
            gt[j - 1] = (weight * slope[:, j - 1] / p * ((grade == j).astype(float) - (grade == j - 1))).sum()
        g = np.empty_like(par)
        g[:n_columns] = np.bincount(column, weights=value * gz[row], minlength=n_columns) + l2 * w / max(1, n_columns)
        g[n_columns] = gt.sum()
        tail = np.cumsum(gt[::-1])[::-1]
        g[n_columns + 1:] = tail[1:] * np.exp(raw[1:])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        par -= rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-9)
    raw = par[n_columns:]
    return par[:n_columns], raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:]))))


def fit_severity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", train_toxic: int = TRAIN_TOXIC, train_clean: int = TRAIN_CLEAN,
                 seed: int = 11) -> SeverityModel:
    """Fit on a hash sample of the labelled documents (bounds are the parameters above).

    First the tasks count the sampled documents of either kind that hold a
    feature; kept are features whose log-odds differ from zero by more than
    chance explains.  Only these are then gathered per document for the
    regression.  The labels are yes/no, so grades are derived: 0 for clean
    documents; toxic ones are 1 to 3 by the tertiles of their words with marker
    features, those at least 20 times as frequent in toxic documents, per word.
    A feature's value is its log-odds times ``log2(1 + words with it)``.
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("lid")).agg(F.max(label_col).cast("int").alias("y")))
    size = {r["y"]: r["n"] for r in known.groupBy((F.col("y") > 0).cast("int").alias("y"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    empty = SeverityModel(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.arange(1.0, GRADES + 1))
    if not size.get(0) or not size.get(1):
        return empty
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("lid")), F.lit(1 << 30)) / float(1 << 30)
    rate = F.when(F.col("y") > 0, min(1.0, train_toxic / size[1])).otherwise(min(1.0, train_clean / size[0]))
    # about train_toxic + train_clean rows of two numbers, whatever the input: a bounded broadcast
    chosen = staged(known.where(u < rate), "toxsample")
    src = docs.select(F.col(id_col).alias("lid"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "lid").select("y", "text")

    def count(batches):
        df = np.zeros((2, DIMS + 1), np.int64)  # the last place counts documents
        for batch in batches:
            for part in slices(batch, "text"):
                y = (part.column("y").to_numpy(zero_copy_only=False) > 0).astype(int)
                _, per, slot, _ = _features(part.column("text"))
                df += np.stack([np.bincount(slot[np.repeat(y, per) == k], minlength=DIMS + 1) for k in (0, 1)])
                df[:, DIMS] += [(y == 0).sum(), (y == 1).sum()]
        at = np.flatnonzero(df.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[0, at]), pa.array(df[1, at])], names=["slot", "df0", "df1"])

    df = staged(src.coalesce(COUNT_TASKS).mapInArrow(count, "slot long, df0 long, df1 long").groupBy("slot")
                .agg(F.sum("df0").alias("df0"), F.sum("df1").alias("df1")), "toxcounts")
    total = df.where(F.col("slot") == DIMS).first()
    if total is None or not total["df0"] or not total["df1"]:
        return empty
    lift = (F.log((F.col("df1") + 0.5) / (total["df1"] + 1)) - F.log((F.col("df0") + 0.5) / (total["df0"] + 1)))
    spread = F.sqrt(1 / (F.col("df1") + 0.5) + 1 / (F.col("df0") + 0.5))
    picked = (df.where(F.col("slot") < DIMS).withColumn("lift", lift)
              .where((F.abs("lift") >= 1) & (F.abs("lift") >= MIN_Z * spread)).orderBy("slot").toPandas())
    if not len(picked):
        return empty
    slots, lifts = picked["slot"].to_numpy(), picked["lift"].to_numpy()
    marker = (picked["df1"].to_numpy() >= 3) & (lifts >= np.log(20))

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                counts, per, slot, n = _features(part.column("text"))
                at = np.minimum(np.searchsorted(slots, slot), len(slots) - 1)
                hit = slots[at] == slot
                ends = pa.array(np.r_[0, np.cumsum(segment_sum(hit, per))].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), pa.array(counts), pa.ListArray.from_arrays(ends, pa.array(at[hit].astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(n[hit].astype(np.int32)))], names=["y", "n", "at", "c"])

    got = (src.mapInArrow(rows, "y int, n long, at array<int>, c array<int>")
           .limit(2 * (train_toxic + train_clean)).toArrow())
    toxic = got["y"].to_numpy() > 0
    at, times = (got[c].combine_chunks() for c in ("at", "c"))
    per = pc.list_value_length(at).to_numpy(zero_copy_only=False).astype(np.int64)
    at, times = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (at, times))
    share = segment_sum(np.where(marker[at], times, 0), per) / np.maximum(got["n"].to_numpy(), 1)
    cut = np.quantile(share[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + (share > cut[0]) + (share > cut[1]), 0)
    weights, thresholds = fit_ordinal(per, at, lifts[at] * np.log2(1 + times), grade, len(slots))
    return SeverityModel(slots, lifts, weights, thresholds)


def severity(docs: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text",
             flag_from: float = FLAG_FROM) -> DataFrame:
    """``doc_id, severity, grade, p_toxic, toxic`` for every row.

    ``severity`` is the expected grade (0 to 3), ``grade`` the most probable
    one, ``toxic`` whether ``P(grade >= 1)`` reaches ``flag_from``.  Null and
    empty texts have no features and get the severity of a text without any;
    repeated rows get the same values; without labels of both kinds nothing is toxic.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                up = model.at_least(model.scores(part.column("text")))
                full = np.concatenate([np.ones((len(up), 1)), up, np.zeros((len(up), 1))], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(up.sum(axis=1)),
                     pa.array((full[:, :-1] - full[:, 1:]).argmax(axis=1).astype(np.int32)), pa.array(up[:, 0]),
                     pa.array(up[:, 0] >= flag_from)], names=["doc_id", "severity", "grade", "p_toxic", "toxic"])

    schema = T.StructType([src.schema["doc_id"], T.StructField("severity", T.DoubleType()),
                           T.StructField("grade", T.IntegerType()), T.StructField("p_toxic", T.DoubleType()),
                           T.StructField("toxic", T.BooleanType())])
    return src.mapInArrow(run, schema)
