"""Mixing sources to target weights with nested hash-threshold histograms.

Each document has a size (words) and a fixed hash.  Per source the words are
summed by hash bucket; the bucket in which the wanted amount is reached is the
only one summed again by the next hash digits, and so on.  The result is one
hash threshold per source; documents are chosen by comparing their own hash
with it, so nothing is sorted and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastebud.llm.common import join_small, staged, words

#: Hash digits (hexadecimal) summed per level, and the number of levels.
DIGITS, LEVELS = 3, 3
WEIGHTS = (5, 2, 1)


def doc_size(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def doc_hash(doc_id: Column, text: Column, source: Column, seed: int) -> Column:
    """``DIGITS * LEVELS`` hexadecimal digits of md5 of id, source and text (nulls as empty strings).

    Rows that share an id are told apart by their texts; only rows that are
    equal in all three share a hash for certain.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (doc_id, source, text)]
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, DIGITS * LEVELS)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), doc_size(F.col(text_col)).alias("size"),
                       doc_hash(F.col(id_col), F.col(text_col), F.col(source_col), seed).alias("h"))


def source_targets(totals: DataFrame, weights=WEIGHTS, cap: float = 3) -> DataFrame:
    """``(source, source_size, target)``: shares of all words by weight, capped at ``cap`` times the source.

    Water filling in closed form: with sources ordered by ``cap * size /
    weight`` the level is the maximum over the prefixes taken as capped of
    ``(all words - capped words) / (all weights - capped weights)``.  One row
    per source passes through the window.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = totals.withColumn("k", F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
    w = w.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("k") + 1).cast("int")))
    w = w.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    before = (Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    every = Window.partitionBy()
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    w = w.withColumn("level", level)
    w = w.withColumn("target", F.least("most", F.max("level").over(every) * F.col("w")))
    return w.select("source", "source_size", "target")


def mixing_plan(slim: DataFrame, weights=WEIGHTS, cap: int = 3) -> DataFrame:
    """One row per source: ``source, source_size, target, passes, most, cell, with_cell``.

    A document is taken ``passes`` times, and once more (``most`` times at
    most) if its hash is below ``cell``, or equal to it and ``with_cell``.  ``slim`` holds ``source,
    size, h`` and must be a table (it is read once per level).
    """
    hist = staged(slim.groupBy("source", F.substring("h", 1, DIGITS).alias("b")).agg(F.sum("size").alias("s")), "mixhist")
    totals = staged(hist.groupBy("source").agg(F.sum("s").alias("source_size")), "mixtotals")
    t = staged(source_targets(totals, weights, cap), "mixtargets")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    t = t.withColumn("passes", F.least(passes, F.lit(cap)).cast("int"))
    t = staged(t.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mixrest")
    prefix = t.select("source", F.lit("").alias("cell"), F.lit(0).cast("long").alias("below"), "rest")
    for level in range(1, LEVELS + 1):
        if level > 1:
            inner = join_small(slim.where("size > 0").withColumnRenamed("h", "hh"), prefix, ["source"], "inner")
            inner = inner.where(F.substring("hh", 1, DIGITS * (level - 1)) == F.col("cell"))
            hist = inner.groupBy("source", F.substring("hh", 1, DIGITS * level).alias("b")).agg(F.sum("size").alias("s"))
        cells = join_small(hist, prefix.drop("cell"), ["source"], "inner")
        upto = Window.partitionBy("source").orderBy("b")
        cells = cells.withColumn("after", F.col("below") + F.sum("s").over(upto))
        hit = cells.where(F.col("after") > F.col("rest")).groupBy("source").agg(
            F.min(F.struct("b", "after", "s", "rest")).alias("x"))
        prefix = staged(hit.select("source", F.col("x.b").alias("cell"), (F.col("x.after") - F.col("x.s")).alias("below"),
                                   F.col("x.rest").alias("rest"), F.col("x.after").alias("after")), "mixcell")
        last, prefix = prefix, prefix.drop("after")
    last = last.select("source", "cell", ((F.col("after") - F.col("rest")) < (F.col("rest") - F.col("below"))).alias("with_cell"))
    plan = join_small(t, last, ["source"], "left")
    return staged(plan.select("source", "source_size", "target", "passes", F.lit(cap).alias("most"), "cell", "with_cell"),
                  "mixplan")


def copies(h: Column) -> Column:
    """How often a document with hash ``h`` is taken, beside the plan's columns of its source."""
    more = (h < F.col("cell")) | ((h == F.col("cell")) & F.col("with_cell"))
    return F.least(F.col("passes") + F.coalesce(more.cast("int"), F.lit(0)), F.col("most"))


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights=WEIGHTS, cap: int = 3, seed: int = 42) -> DataFrame:
    """Digest of the mix: ``doc_id, source, size, source_size, target, copies, taken`` for every row.

    Null texts have size 0 and are taken like any other (0 words); null sources
    are one source, ordered last; rows that repeat id, source and text have the
    same hash and go in or out together; an empty table gives no rows; columns of
    other names are ignored and long texts are counted whole.
    The words of a source differ from its target by at most half the size of
    the documents in its boundary cell (one document, unless hashes collide).
    """
    slim = staged(sized(docs, id_col, text_col, source_col, seed), "mixsizes")
    out = join_small(slim, mixing_plan(slim, weights, cap), ["source"], "left")
    out = out.withColumn("copies", copies(F.col("h")))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights=WEIGHTS, cap: int = 3, seed: int = 42) -> DataFrame:
    """The mixed corpus: the rows of ``docs`` (all columns), each as often as the mix takes it."""
    slim = staged(sized(docs, id_col, text_col, source_col, seed), "mixsizes")
    plan = mixing_plan(slim, weights, cap)
    packed = docs.select(F.struct("*").alias("row"), F.col(source_col).alias("source"),
                         doc_hash(F.col(id_col), F.col(text_col), F.col(source_col), seed).alias("h"))
    out = join_small(packed, plan, ["source"], "inner").withColumn("copies", copies(F.col("h")))
    return (out.where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("one"))
            .select("row.*"))
