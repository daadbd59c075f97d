"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastebud.llm import (byte_bpe, code_books, embed_dedup, licenses, mixing, piece_viterbi, quality_rules, sharding,
                          simhash, simple8b, token_align, toxicity, weak_quality)
from tastebud.llm.common import prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.host_quality_rules(_docs(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", F.round("host_rate", 6).alias("host_rate"))


def bad_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over documents of which some moved to a host of mostly cut texts: the host's verdict takes the rest of them."""
    docs = _docs(spark, sf_dir)
    moved = F.col("doc_id") % _BAD_HOST == 0
    docs = docs.select("doc_id", F.when(moved, F.lit("bad.example")).otherwise(F.col("source")).alias("source"),
                       F.when(moved & (F.col("doc_id") % 4 != 0), F.substring("text", 1, 60)).otherwise(F.col("text")).alias("text"))
    out = quality_rules.host_quality_rules(docs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", F.round("host_rate", 6).alias("host_rate"))


def op2_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    model = toxicity.fit_severity(docs, _table(spark, sf_dir, "labels"))
    return toxicity.severity(docs, model)


def op3_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = simple8b.write_token_files(_docs(spark, sf_dir))
    return simple8b.id_checksums(simple8b.read_token_files(images))


def op4_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_docs(spark, sf_dir)).select("doc_id", "license", "dice", "matches")


def op5_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.write_shards(_docs(spark, sf_dir))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return rows.select(F.col("row.doc_id").alias("doc_id"), sharding.row_bytes(F.col("row.text")).alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op6_embedding_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return weak_quality.quality_scores(docs, weak_quality.fit_quality(docs))


def op8_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_docs(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = piece_viterbi.load_pieces()
    coded = piece_viterbi.encode_documents(_docs(spark, sf_dir), table, carry=True)
    coded = coded.withColumn("ids_hash", F.xxhash64("ids"))
    back = piece_viterbi.decode_documents(coded, table, ("doc_id", "n_tokens", "ids_hash", "text"))
    return back.select("doc_id", "n_tokens", "ids_hash",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_align.align_documents(_docs(spark, sf_dir), token_align.load_pair())
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256))
    return out.withColumn("groups_sha256", digest).drop("groups")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = byte_bpe.load_ranks()
    coded = byte_bpe.encode_documents(_docs(spark, sf_dir), table)
    coded = coded.withColumn("ids_sha256", F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256))
    back = byte_bpe.decode_documents(coded, table, ("doc_id", "n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = code_books.compress_vectors(_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", code_books.code_text(F.col("codes")).alias("code"), "error", "label_error",
                        F.lit(code_books.codebooks_sha256(books)).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, bad_host_rules, op2_toxicity_ordinal, op3_simple8b, op4_license_dice, op5_external_shuffle, op6_embedding_codes,
    op7_weak_quality, op8_simhash_pivots, op9_mixing, op10_piece_viterbi, op11_token_alignment, op12_byte_bpe,
    op13_vector_codes)}

_WORDS = "list_filter(regexp_split_to_array(coalesce({t}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

_OP1 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, {_WORDS.format(t="text")} AS w
  FROM documents),
win AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT rid, count(*) AS n FROM (
    SELECT DISTINCT rid, j FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice))
  GROUP BY rid),
lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
s AS (
  SELECT d.doc_id, d.source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid)),
f AS (SELECT *, (n_words < {quality_rules.MIN_WORDS}
                 OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM s),
host AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS bad, bad / n AS r
  FROM f WHERE source IS NOT NULL GROUP BY source),
prior AS (
  SELECT m, CASE WHEN v > 0 THEN greatest(1.0, least(1000.0, m * (1 - m) / v - 1)) ELSE 1000.0 END AS k
  FROM (SELECT avg(r) AS m, var_pop(r) AS v FROM host)),
verdict AS (
  SELECT source, host_rate, host_rate - {quality_rules.HOST_DOUBT} * sqrt(host_rate * (1 - host_rate) / (n + k + 1)) >
         greatest({quality_rules.HOST_RATES[0]}, least({quality_rules.HOST_RATES[1]}, {quality_rules.HOST_FACTOR} * m)) AS host_failed
  FROM (SELECT source, n, m, k, (bad + m * k) / (n + k) AS host_rate FROM host CROSS JOIN prior))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_failed, false) AS kept, round(host_rate, 6) AS host_rate
FROM f LEFT JOIN verdict USING (source)"""

#: Every so manyth document moves to a host of its own, three of four of them without most of their words.
_BAD_HOST = 25
_OP1_BAD_HOST = _OP1.replace("FROM documents)", f"""FROM (
    SELECT doc_id, CASE WHEN doc_id % {_BAD_HOST} = 0 THEN 'bad.example' ELSE source END AS source,
           CASE WHEN doc_id % {_BAD_HOST} = 0 AND doc_id % 4 <> 0 THEN left(text, 60) ELSE text END AS text FROM documents))""")

_TEMPLATE_ROWS = ", ".join(
    f"('{name}', {m}, {most}, '{pair}', {times}, {decides}, {n})" for name, m, most, pair, times, decides, n, _
    in licenses.template_rows(licenses.TEMPLATES, licenses.DECIDING, licenses.MIN_DICE))

_OP4 = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(
    regexp_split_to_array(lower(coalesce(text, '')), '[\\x00-/:-@\\[-`{{-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
pairs AS (SELECT rid, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT rid, w, unnest(range(1, len(w))) AS i FROM d)),
template(name, m, most, pair, times, decides, n_decide) AS (VALUES {_TEMPLATE_ROWS}),
hit AS MATERIALIZED (
  SELECT rid, name, m, most, pair, times, decides, n_decide, pos,
         row_number() OVER (PARTITION BY rid, name, pair ORDER BY pos) AS k
  FROM pairs JOIN template USING (pair)),
h AS MATERIALIZED (
  SELECT x.*, y.pos AS prev FROM hit x LEFT JOIN hit y
  ON x.rid = y.rid AND x.name = y.name AND x.pair = y.pair AND y.k = x.k - x.times),
reach AS (
  SELECT a.rid, a.name, a.m, a.n_decide, a.pos AS s, e.pos AS e,
         -2.0::DOUBLE * row_number() OVER (PARTITION BY a.rid, a.name, a.pos ORDER BY e.pos) / (e.pos - a.pos + 1 + a.m) AS minus
  FROM h a JOIN h e ON a.rid = e.rid AND a.name = e.name AND e.pos >= a.pos AND e.pos < a.pos + a.most
                       AND (e.prev IS NULL OR e.prev < a.pos)),
best AS (
  SELECT rid, name, m, n_decide, s, min(minus) AS minus, arg_min(e, [minus, e]) AS e
  FROM reach GROUP BY rid, name, m, n_decide, s HAVING min(minus) <= -{licenses.MIN_DICE}),
decided AS MATERIALIZED (
  SELECT b.* FROM best b WHERE b.n_decide = (
    SELECT count(DISTINCT x.decides) FROM h x
    WHERE x.rid = b.rid AND x.name = b.name AND x.decides > 0 AND x.pos BETWEEN b.s AND b.e)),
own AS MATERIALIZED (
  SELECT * FROM decided a WHERE NOT EXISTS (
    SELECT 1 FROM decided b WHERE a.rid = b.rid AND a.name = b.name AND b.s <= a.e + 1 AND a.s <= b.e + 1
                                  AND row(b.minus, b.s) < row(a.minus, a.s))),
top AS MATERIALIZED (
  SELECT * FROM own a WHERE NOT EXISTS (
    SELECT 1 FROM own b WHERE a.rid = b.rid AND b.s <= a.e + 1 AND a.s <= b.e + 1
                              AND row(b.minus, -b.m, b.name, b.s) < row(a.minus, -a.m, a.name, a.s))),
doc AS (
  SELECT rid, name, minus, count(*) OVER (PARTITION BY rid) AS n FROM top
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY minus, m DESC, name) = 1)
SELECT doc_id, name AS license, -minus AS dice, coalesce(n, 0) AS matches FROM d LEFT JOIN doc USING (rid)"""

_OP6 = f"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS MATERIALIZED (
  SELECT rid, vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (
  SELECT a.rid AS a, b.rid AS b FROM ok a JOIN ok b
  ON a.label = b.label AND a.rid <> b.rid AND len(a.e) = len(b.e)
     AND list_dot_product(a.e, b.e) >= {embed_dedup.MIN_COSINE} * a.norm * b.norm),
reach AS (
  SELECT rid AS a, rid AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT reach.a AS rid, min(v.vec_id) AS component_id FROM reach JOIN v ON v.rid = reach.b GROUP BY reach.a)
SELECT v.vec_id, count(link.b) AS n_links, component_id, v.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN comp USING (rid) LEFT JOIN link ON link.a = v.rid GROUP BY v.rid, v.vec_id, component_id"""

_OP9 = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({_WORDS.format(t="text")}) AS BIGINT) AS size,
         substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(source, '') || ':' || coalesce(text, '')), 1, {mixing.DIGITS * mixing.LEVELS}) AS h
  FROM documents),
src AS (
  SELECT source, sum(size) AS s, CAST([{", ".join(map(str, mixing.WEIGHTS))}][
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS DOUBLE) AS w
  FROM d GROUP BY source),
lev AS (
  SELECT max((total - c) / (weights - x)) AS level FROM (
    SELECT sum(s) OVER () AS total, sum(w) OVER () AS weights,
           coalesce(sum(3.0::DOUBLE * s) OVER o, 0.0) AS c, coalesce(sum(w) OVER o, 0.0) AS x
    FROM src WINDOW o AS (ORDER BY 3.0::DOUBLE * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
t AS (
  SELECT source, CAST(s AS BIGINT) AS source_size, least(3.0::DOUBLE * s, level * w) AS target,
         CASE WHEN s > 0 THEN CAST(least(3, floor(least(3.0::DOUBLE * s, level * w) / s)) AS BIGINT) ELSE 0 END AS passes
  FROM src CROSS JOIN lev),
cell AS (
  SELECT source, h, sum(s) OVER (PARTITION BY source ORDER BY h) AS upto, s
  FROM (SELECT source, h, sum(size) AS s FROM d GROUP BY source, h)),
more AS (
  SELECT c.source, c.h, CASE WHEN upto <= rest THEN 1 WHEN upto - s > rest THEN 0 WHEN upto - rest < rest - (upto - s) THEN 1
                             ELSE 0 END AS extra
  FROM cell c JOIN (SELECT source, target - passes * source_size AS rest FROM t) r ON c.source IS NOT DISTINCT FROM r.source)
SELECT d.doc_id, d.size, t.source_size, t.target, CAST((t.passes + more.extra) * d.size AS BIGINT) AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
JOIN more ON d.source IS NOT DISTINCT FROM more.source AND d.h = more.h"""

def _nearest(books: str) -> str:
    """Entry and squared distance of every part of every vector."""
    return f"""
  SELECT rid, part, arg_min(entry, [d, entry]) AS entry, min(d) AS d, any_value(x) AS x FROM (
    SELECT rid, part, entry, cut.x AS x,
           list_sum(list_transform(list_zip(cut.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM cut JOIN {books} b USING (part))
  GROUP BY rid, part"""


def _updated(books: str, near: str) -> str:
    """The entries replaced by the floor of their parts' means."""
    return f"""
  SELECT part, entry, coalesce(m.x, b.x) AS x FROM {books} b LEFT JOIN (
    SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS x FROM (
      SELECT part, entry, j, sum(x[j]) AS s, count(*) AS n
      FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS j FROM {near}) GROUP BY part, entry, j)
    GROUP BY part, entry) m USING (part, entry)"""


_OP13 = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor({code_books.SCALE} * x) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS MATERIALIZED (
  SELECT rid, vec_id, part, ints[part * len(ints) // {code_books.PARTS} + 1:(part + 1) * len(ints) // {code_books.PARTS}] AS x
  FROM (SELECT *, unnest(range({code_books.PARTS})) AS part FROM v)),
b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM cut
  WHERE rid IN (SELECT rid FROM v ORDER BY vec_id LIMIT {code_books.ENTRIES})),
n0 AS MATERIALIZED ({_nearest("b0")}),
b1 AS MATERIALIZED ({_updated("b0", "n0")}),
n1 AS MATERIALIZED ({_nearest("b1")}),
b2 AS MATERIALIZED ({_updated("b1", "n1")}),
n2 AS MATERIALIZED ({_nearest("b2")}),
coded AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM n2 GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
FROM v JOIN coded USING (rid)"""

ORACLE: dict[str, str] = {"op1_quality_rules": _OP1, "bad_host_rules": _OP1_BAD_HOST, "op4_license_dice": _OP4, "op6_embedding_codes": _OP6, "op9_mixing": _OP9,
                          "op13_vector_codes": _OP13}
