"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on every document.  Their votes
are counted by pattern over all documents (at most ``3 ** labellers``
patterns), expectation-maximisation on these counts estimates how accurate
each labeller is on good and on bad documents, and the posterior of each
document's votes is the soft label on which a hashed linear scorer is trained.
The scorer sees words, their shapes and repetition, never a vote, so it also
judges documents on which every labeller abstains.
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

from tastebud.llm.arrowtext import class_counts, segment_sum, slices, split_words, word_codes

DIMS = 1 << 16
#: Documents on which the scorer is trained, at most about this many (chosen by hash within their vote pattern).
TRAIN_DOCS = 12_000
KEEP_FROM = 0.5
#: Prior of a labeller's errors on good documents while the rounds run: their rate, and the prior's weight as a share of its votes.
ERROR_PRIOR, PRIOR_SHARE = 1e-4, 1.0

#: (name, measure, good up to, bad from, words needed); ``None``: on that side the labeller abstains.
LABELLERS = (
    ("symbols", "symbol_share", 0.002, 0.015, 1),
    ("capitals", "capital_share", 0.15, 0.5, 5),
    ("shouting", "shout_share", 0.05, 0.3, 5),
    ("stutter", "stutter_share", 0.05, 0.15, 20),
    ("variety", "same_share", 0.5, 0.8, 50),
    ("letters", "other_share", 0.08, 0.2, 5),
    ("digits", "digit_share", 0.05, 0.2, 5),
    ("long words", "word_length", 8.0, 14.0, 5),
    ("tables", "bare_share", 0.03, 0.15, 5),
    ("marked words", "marked_share", 0.02, 0.15, 5),
)


def repeats(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a word equals the one before it, and whether it was seen earlier in its run of 1000 words.

    Runs, as a long text may well repeat most of its words.
    """
    doc = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    run = (np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)) // 1000
    size, runs = int(codes.max(initial=0)) + 1, int(run.max(initial=0)) + 1
    seen = np.ones(len(codes), bool)
    seen[np.unique((doc * runs + run) * size + codes, return_index=True)[1]] = False
    return again, seen


def measures(texts: pa.Array) -> tuple[dict[str, np.ndarray], pa.Array, np.ndarray]:
    """Measures of each whole text, its words and their number."""
    texts = pc.fill_null(texts, "")
    flat, counts = split_words(texts)
    codes, dictionary = word_codes(flat)
    again, seen = repeats(codes, counts)
    lens = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = segment_sum(lens, counts)
    cls = class_counts(texts)

    def found(pattern):
        return pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)

    def shape(pattern):
        return pc.match_substring_regex(dictionary, pattern).to_numpy(zero_copy_only=False).astype(np.int64)[codes]

    n, c, letters = np.maximum(counts, 1), np.maximum(chars, 1), np.maximum(cls["letters"], 1)
    return {"symbol_share": found(r"[#*$%&|<>]") / c, "capital_share": cls["capitals"] / letters,
            "shout_share": found("!") / n, "stutter_share": segment_sum(again.astype(np.int64), counts) / n,
            "same_share": segment_sum(seen.astype(np.int64), counts) / n,
            "bare_share": segment_sum(shape("^[^\\pL\\pN]+$"), counts) / n,
            "marked_share": segment_sum(shape("[\\pL\\pN][^\\pL\\pN.,;:?'\"()-]+[.,;:]?$"), counts) / n,
            "other_share": 1 - (cls["letters"] + cls["digits"]) / c, "digit_share": cls["digits"] / c,
            "word_length": chars / n}, flat, counts


def votes(m: dict[str, np.ndarray], counts: np.ndarray) -> np.ndarray:
    """1 good, 0 bad, 2 abstain; one column per labeller."""
    out = np.full((len(counts), len(LABELLERS)), 2, np.int8)
    for j, (_, measure, good, bad, need) in enumerate(LABELLERS):
        enough = counts >= need
        out[enough & (m[measure] <= good), j] = 1
        out[enough & (m[measure] >= bad), j] = 0
    return out


def pattern_of(v: np.ndarray) -> np.ndarray:
    return v.astype(np.int64) @ (3 ** np.arange(v.shape[1]))


def votes_of(patterns: np.ndarray) -> np.ndarray:
    return (patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3).astype(np.int8)


@dataclass
class LabelModel:
    """``prior`` of good; ``accuracy[0]`` on bad, ``accuracy[1]`` on good documents, per labeller."""

    prior: float
    accuracy: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of good; abstentions carry no evidence."""
        good, bad = self.accuracy[1], self.accuracy[0]
        odds = np.log(self.prior) - np.log1p(-self.prior) + np.where(
            v == 1, np.log(good) - np.log1p(-bad), np.where(v == 0, np.log1p(-good) - np.log(bad), 0.0)).sum(axis=1)
        return 1 / (1 + np.exp(-odds))


def fit_label_model(patterns: np.ndarray, n: np.ndarray, rounds: int = 500, smooth: float = 1.0) -> LabelModel:
    """Expectation-maximisation from the counts of vote patterns.

    A document starts as bad if any labeller says so, as most kinds of bad
    text are seen by one or two of them only.  During the rounds a beta prior
    that weighs ``PRIOR_SHARE`` of a labeller's votes says that it seldom errs
    on good documents: lone bad votes fit a rare kind of bad text as well as
    errors, and the prior decides only where the other votes do not.  The
    accuracies returned are those of the votes under the last posterior,
    without that prior, so a labeller that does err on good documents is
    reported as it is.  On bad documents an accuracy may be low (a labeller
    does not see the other kinds), but a bad vote is never likelier on good ones.
    """
    v = votes_of(patterns)

    def accuracies(p: np.ndarray, share: float) -> np.ndarray:
        acc = np.empty((2, v.shape[1]))
        for y, w in ((1, n * p), (0, n * (1 - p))):
            right, wrong = (w[:, None] * (v == y)).sum(axis=0), (w[:, None] * (v == 1 - y)).sum(axis=0)
            weight = smooth + share * (right + wrong) if y else 2 * smooth
            acc[y] = (right + (1 - ERROR_PRIOR if y else 0.5) * weight) / (right + wrong + weight)
        acc = np.clip(acc, 0.001, 0.99999)
        acc[0] = np.maximum(acc[0], 1 - acc[1])
        return acc

    p = np.where((v == 0).any(axis=1), 0.1, 0.9)
    model = LabelModel(0.5, np.full((2, v.shape[1]), 0.7))
    for _ in range(rounds):
        acc = accuracies(p, PRIOR_SHARE)
        moved = np.abs(acc - model.accuracy).max()
        model = LabelModel(float(np.clip(((n * p).sum() + smooth) / (n.sum() + 2 * smooth), 0.01, 0.99)), acc)
        p = model.posterior(v)
        if moved < 1e-9:
            break
    return LabelModel(model.prior, accuracies(p, 0.0))


def word_shapes(words: pa.Array) -> pa.Array:
    """Words with their letters and digits reduced to classes; other characters stay.

    ``0`` a run of digits, ``L`` 15 letters or more, ``AA`` capitals, ``A`` one
    capital, ``a`` other letters: ``Word!`` becomes ``Aa!``.
    """
    for pattern, by in ((r"\p{N}+", "0"), (r"\p{L}{15,}", "L"), (r"\p{Lu}{2,}", "AA"), (r"\p{Lu}", "A"),
                        (r"[\p{Ll}\p{Lo}\p{Lm}\p{Lt}]+", "a")):
        words = pc.replace_substring_regex(words, pattern, by)
    return words


def features(flat: pa.Array, counts: np.ndarray, dims: int = DIMS):
    """Sparse rows of hashed features: ``(features per text, slot, value)``.

    Words (log counts, length 1), word shapes, and two marks: a word that equals
    the one before, and one seen earlier in its run of 1000 words.  A shape or
    mark counts by the logarithm of its share of the words.
    """
    codes, dictionary = word_codes(flat)
    doc = np.repeat(np.arange(len(counts)), counts)
    digest = xxhash.xxh32_intdigest

    def slots(names: list, kind: str) -> np.ndarray:
        return np.fromiter((digest(kind + x) % dims for x in names), np.int64, len(names))

    key, n = np.unique(doc * dims + slots(dictionary.to_pylist(), "")[codes], return_counts=True)
    value = np.log1p(n)
    norm = np.sqrt(np.bincount(key // dims, weights=value * value, minlength=len(counts)))
    value = value / np.maximum(norm, 1e-12)[key // dims]

    shape_codes, shapes = word_codes(word_shapes(dictionary))
    shape = slots(shapes.to_pylist(), "shape ")[shape_codes]
    again, seen = repeats(codes, counts)
    marks = slots(["again", "seen"], "mark ")
    other, m = np.unique(np.concatenate([doc * dims + shape[codes], doc[again] * dims + marks[0],
                                         doc[seen] * dims + marks[1]]), return_counts=True)
    share = 2 * np.log1p(100 * m / counts[other // dims]) / np.log(101)
    key, value = np.concatenate([key, other]), np.concatenate([value, share])
    order = np.argsort(key, kind="stable")
    return np.bincount(key // dims, minlength=len(counts)), key[order] % dims, value[order]


def draw_rates(n: np.ndarray, train_docs: int) -> np.ndarray:
    """Share of each pattern's documents to draw: about ``train_docs`` in all, and some of every pattern.

    Half of the sample at most goes to a floor that is equal for all patterns,
    so rare ones are taken whole; the rest is in proportion.
    """
    floor = train_docs // (2 * max(1, len(n)))
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if np.minimum(n, np.maximum(mid * n, floor)).sum() <= train_docs else (low, mid)
    share = 1.0 if n.sum() <= train_docs else low
    return np.minimum(1.0, np.maximum(share, floor / np.maximum(n, 1)))


def fit_scorer(per: np.ndarray, index: np.ndarray, value: np.ndarray, target: np.ndarray, dims: int = DIMS,
               steps: int = 200, rate: float = 0.1, l2: float = 1e-6,
               weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels (full-batch Adam), documents counting by ``weight``."""
    w, b = np.zeros(dims + 1), 0.0
    if not len(target):
        return w[:dims], b
    part = np.full(len(target), 1 / len(target)) if weight is None else weight / weight.sum()
    penalty = np.full(dims + 1, l2)
    penalty[dims] = 0
    row = np.repeat(np.arange(len(target)), per)
    m1, m2 = np.zeros(dims + 1), np.zeros(dims + 1)
    for t in range(1, steps + 1):
        score = segment_sum(w[index] * value, per) + w[dims]
        err = (1 / (1 + np.exp(-score)) - target) * part
        g = np.bincount(index, weights=value * err[row], minlength=dims + 1) + penalty * w
        g[dims] = err.sum()
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w -= rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-9)
    return w[:dims], float(w[dims])


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float


def fit_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS,
                seed: int = 7) -> QualityModel:
    """Label model over all documents, scorer on a hash sample of about ``train_docs`` of them.

    The sample is drawn by vote pattern (:func:`draw_rates`), and from every
    pattern at least the document of the smallest hash; a document stands for
    its pattern's count divided by the number drawn.  Wholly equal rows share a
    hash and are one row of the sample, counted.  To the driver come the
    pattern counts (at most ``3 ** labellers`` rows) and the sampled documents'
    sparse features (a documented bound, whatever the input).
    """
    src = docs.select(F.col(text_col).alias("text"), F.shiftrightunsigned(
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 1).alias("h"))

    def vote(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                m, _, counts = measures(part.column("text"))
                key, back, n = np.unique(pattern_of(votes(m, counts)), return_inverse=True, return_counts=True)
                least = np.full(len(key), np.iinfo(np.int64).max)
                np.minimum.at(least, back, part.column("h").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), pa.array(least)],
                                                 names=["pattern", "n", "least"])

    counted = (src.mapInArrow(vote, "pattern long, n long, least long").groupBy("pattern")
               .agg(F.sum("n").alias("n"), F.min("least").alias("least")).orderBy("pattern").toPandas())
    patterns, n = counted["pattern"].to_numpy(np.int64), counted["n"].to_numpy(np.float64)
    model = fit_label_model(patterns, n)
    if not len(patterns):
        return QualityModel(model, np.zeros(DIMS), 0.0)
    top = np.iinfo(np.int64).max
    limits = np.maximum(np.array([min(top, int(r * 2.0 ** 63)) for r in draw_rates(n, train_docs)], np.int64),
                        counted["least"].to_numpy(np.int64))

    def rows(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                m, _, counts = measures(part.column("text"))
                key = pattern_of(votes(m, counts))
                h = part.column("h").to_numpy(zero_copy_only=False)
                drawn = np.flatnonzero(h <= limits[np.searchsorted(patterns, key)])
                if not len(drawn):
                    continue
                _, first, copies = np.unique(h[drawn], return_index=True, return_counts=True)
                some = part.take(pa.array(drawn[first]))
                m, flat, counts = measures(some.column("text"))
                v = votes(m, counts)
                per, index, value = features(flat, counts)
                ends = pa.array(np.r_[0, np.cumsum(per)].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [some.column("h"), pa.array(pattern_of(v)), pa.array(copies),
                     pa.ListArray.from_arrays(ends, pa.array(index.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(value.astype(np.float32)))],
                    names=["h", "pattern", "copies", "index", "value"])

    sample = (src.mapInArrow(rows, "h long, pattern long, copies long, index array<int>, value array<float>")
              .groupBy("h", "pattern").agg(F.sum("copies").alias("copies"), F.first("index").alias("index"),
                                           F.first("value").alias("value"))
              .toArrow().sort_by([("h", "ascending"), ("pattern", "ascending")]))
    index, value = (sample[c].combine_chunks() for c in ("index", "value"))
    per = pc.list_value_length(index).to_numpy(zero_copy_only=False).astype(np.int64)
    drawn, copies = sample["pattern"].to_numpy(), sample["copies"].to_numpy().astype(np.float64)
    at = np.searchsorted(patterns, drawn)
    weight = copies * (n / np.maximum(np.bincount(at, weights=copies, minlength=len(n)), 1))[at]
    weights, bias = fit_scorer(per, index.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                               value.flatten().to_numpy(zero_copy_only=False).astype(np.float64),
                               model.posterior(votes_of(drawn)), weight=weight)
    return QualityModel(model, weights, bias)


def quality_scores(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
                   carry: bool = False, keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id, score, weak_label, kept`` for every row (with ``carry`` also the row as struct ``row``).

    ``score`` is the linear scorer's probability of good, ``weak_label`` the
    posterior of the labellers' votes; ``kept`` follows the score, a tie with
    ``keep_from`` is kept.  Null and empty texts have nothing to judge: score 0,
    not kept.  Long texts are judged whole.  Repeated rows get the same score
    each; an empty table gives no rows.  Other columns do not matter, whatever
    their names: with ``carry`` they are inside ``row``.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      *([F.struct("*").alias("row")] if carry else []))
    keep = [c for c in src.columns if c != "text"]
    weights = model.weights.astype(np.float32)
    bias, labels = model.bias, model.labels

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                m, flat, counts = measures(part.column("text"))
                v = votes(m, counts)
                per, index, value = features(flat, counts)
                score = 1 / (1 + np.exp(-(segment_sum(weights[index] * value, per) + bias)))
                score = np.where(counts > 0, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [pa.array(score), pa.array(labels.posterior(v)),
                                                      pa.array((score >= keep_from) & (counts > 0))],
                    names=[*keep, "score", "weak_label", "kept"])

    extra = [T.StructField("score", T.DoubleType()), T.StructField("weak_label", T.DoubleType()),
             T.StructField("kept", T.BooleanType())]
    return src.mapInArrow(run, T.StructType([*(src.schema[c] for c in keep), *extra]))
