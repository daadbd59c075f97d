"""Host-level quality rules: rule failures by domain, shrunk with an empirical beta prior."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastebud.llm.common import WS_CHARS, join_small, let, staged, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A host is rejected as a whole if its failure rate is, beyond reasonable doubt, so many times the prior's mean and at least
#: the lower bound; no more than the upper bound is asked of it.  Doubt: so many standard deviations of the posterior.
HOST_FACTOR, HOST_RATES, HOST_DOUBT = 3.0, (0.5, 0.8), 2.33


def _repeat_words(ws: Column) -> Column:
    """Words inside 3-word windows whose words occur at least twice in the text.

    Windows are compared by the 64-bit hash of their words.  The hashes are
    sorted with their positions, equal neighbours are repeated windows, and
    the sorted positions of those cover ``min(3, distance to the next)`` words
    each: linear but for the sort, whatever the text repeats.
    """
    hashes = F.when(F.size(ws) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(ws) - 3),
        lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))).otherwise(
            F.array().cast("array<bigint>"))

    def covered(hs):
        runs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(runs, lambda r: let(
            F.sort_array(F.transform(
                F.filter(r, lambda x, i: F.coalesce(x["h"] == F.get(r, i + 1)["h"], F.lit(False))
                         | F.coalesce((i > 0) & (x["h"] == F.get(r, F.greatest(i - 1, F.lit(0)))["h"]), F.lit(False))),
                lambda x: x["i"])),
            lambda p: F.aggregate(
                F.transform(p, lambda a, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - a, F.lit(3)))),
                F.lit(0).cast("long"), lambda acc, x: acc + x)))

    return let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long"))
               .otherwise(covered(hs)))


def base_stats(text: Column) -> Column:
    """Struct ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of the whole text (null: none)."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, WS_CHARS, "")) > 0)
    return F.struct(
        F.size(words(t)).cast("long").alias("n_words"),
        F.length(F.translate(t, WS_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda l: (F.size(l) - F.size(F.array_distinct(l))).cast("long")).alias("n_dup_lines"),
        let(words(t), _repeat_words).alias("n_repeat_words"))


def host_verdicts(stats: DataFrame, factor: float = HOST_FACTOR, rates: tuple = HOST_RATES, doubt: float = HOST_DOUBT) -> DataFrame:
    """``host, n_docs, n_failed, host_rate, host_failed`` from rows with ``host, base_failed``.

    The beta prior comes from the hosts themselves (method of moments: mean
    and variance of the hosts' raw rates; strength kept within 1 and 1000) and
    each rate is shrunk to ``(failed + a) / (docs + a + b)``, the mean of the
    host's beta posterior.  A host fails if this mean less ``doubt`` standard
    deviations of the posterior is above ``factor`` times the prior's mean, a
    bar kept within ``rates``.  Null hosts have no verdict.  Partial sums are
    taken before the shuffle.
    """
    hosts = (stats.where(F.col("host").isNotNull()).groupBy("host")
             .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")))
    hosts = staged(hosts, "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    raw = F.when(F.col("v") > 0, F.col("m") * (1 - F.col("m")) / F.col("v") - 1).otherwise(F.lit(1000.0))
    prior = prior.select("m", F.greatest(F.lit(1.0), F.least(F.lit(1000.0), raw)).alias("s"))
    m, s = prior.select("m").scalar(), prior.select("s").scalar()
    hosts = hosts.withColumn("host_rate", (F.col("n_failed") + m * s) / (F.col("n_docs") + s))
    spread = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("n_docs") + s + 1))
    bar = F.greatest(F.lit(rates[0]), F.least(F.lit(rates[1]), factor * m))
    return hosts.withColumn("host_failed", F.col("host_rate") - doubt * spread > bar)


def host_quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                       carry: bool = False, **verdict) -> DataFrame:
    """Rule counts, the document's own verdict and that of its host, for every row of ``docs``.

    Columns: ``doc_id, host``, the counts of :func:`base_stats`, ``base_failed,
    n_docs, n_failed, host_rate, host_failed, kept``, and with ``carry`` the
    whole input row as struct ``row``.  Null and empty texts have no words and
    fail; a null host is judged by the document alone; repeated rows each
    count; an empty table gives no rows; columns of other names stay in ``row``
    and long texts are counted whole.  ``verdict``: see :func:`host_verdicts`.
    """
    cols = [F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), base_stats(F.col(text_col)).alias("s")]
    if carry:
        cols.append(F.struct("*").alias("row"))
    out = docs.select(*cols)
    failed = (F.col("s.n_words") < MIN_WORDS) | (100 * F.col("s.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("s.n_words"))
    out = staged(out.withColumn("base_failed", failed), "rules")  # once: the texts are read by both uses
    hosts = staged(host_verdicts(out.select("host", "base_failed"), **verdict), "verdicts")
    out = join_small(out, hosts, ["host"], "left")
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("host_failed"), F.lit(False))
    return out.select("doc_id", "host", "s.*", "base_failed", "n_docs", "n_failed", "host_rate", "host_failed",
                      kept.alias("kept"), *(["row"] if carry else []))
