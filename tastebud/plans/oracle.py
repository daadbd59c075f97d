"""DuckDB SQL statements that recompute each registered query independently.

Building blocks are common-table expressions over the pre-registered views
(``part orders lineitem embeddings ...``).  They restate the *semantics*
(positional split after an md5 shuffle, mean profiles, plain cosine,
metrics) in plain SQL, with no shared code path with the Spark operators.
"""

from __future__ import annotations

SEED = "42"
RATIO = "CAST(0.8 AS DOUBLE)"
K = 20


def _md5(*cols: str) -> str:
    inner = ", ".join([f"'{SEED}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"md5(concat_ws(':', {inner}))"


INTER = """inter AS (
  SELECT DISTINCT o.o_custkey AS user_id, l.l_partkey AS item_id, CAST(1.0 AS DOUBLE) AS play
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

INTER_REPEATED = """inter_rep AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, CAST(1.0 AS DOUBLE) AS play
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_NTRAIN = f"greatest(1, CAST(floor(n * {RATIO}) AS BIGINT))"

def split_of(source: str) -> str:
    """Per-user split of a CTE ``source(user_id, item_id, play)``: ``ranked split train test``."""
    return f"""ranked AS (
  SELECT user_id, item_id, play,
         row_number() OVER (PARTITION BY user_id ORDER BY {_md5('user_id', 'item_id')}, item_id) AS pos,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM {source}),
split AS (
  SELECT user_id, item_id, play, pos, n,
         CASE WHEN n - {_NTRAIN} = 0 AND n > 1 THEN n - 1 ELSE {_NTRAIN} END AS n_train
  FROM ranked WHERE n >= 2),
train AS (SELECT user_id, item_id, play, pos FROM split WHERE pos <= n_train),
test AS (SELECT user_id, item_id, play, pos FROM split WHERE pos > n_train)"""


SPLIT = split_of("inter")

ITEMS = """items AS (
  SELECT vec_id AS item_id, embedding AS vec FROM embeddings
  WHERE vec_id IN (SELECT p_partkey FROM part)),
iel AS (
  SELECT item_id, generate_subscripts(vec, 1) AS d, CAST(unnest(vec) AS DOUBLE) AS x FROM items)"""

def content_ctes(p: str = "", items: str = "items", iel: str = "iel", k: int = K) -> str:
    """Cosine top-k over an item table ``items(item_id, ...)`` with long form ``iel(item_id, d, x)``.

    Produces ``{p}crecs(user_id, item_id, score, rank)``; ``p`` prefixes the CTE names.
    """
    return f"""{p}seen AS (
  SELECT t.user_id, t.item_id FROM train t JOIN {items} i ON t.item_id = i.item_id),
{p}prof AS (
  SELECT s.user_id, e.d, avg(e.x) AS x FROM {p}seen s JOIN {iel} e ON s.item_id = e.item_id
  GROUP BY s.user_id, e.d),
{p}pnorm AS (SELECT user_id, sqrt(sum(x * x)) AS nrm FROM {p}prof GROUP BY user_id),
{p}inorm AS (SELECT item_id, sqrt(sum(x * x)) AS nrm FROM {iel} GROUP BY item_id),
{p}dots AS (
  SELECT p.user_id, e.item_id, sum(p.x * e.x) AS dot FROM {p}prof p JOIN {iel} e ON p.d = e.d
  GROUP BY p.user_id, e.item_id),
{p}cand AS (
  SELECT d.user_id, d.item_id,
         CASE WHEN pn.nrm > 0 AND i.nrm > 0 THEN d.dot / (pn.nrm * i.nrm) ELSE 0.0 END AS score
  FROM {p}dots d JOIN {p}pnorm pn ON d.user_id = pn.user_id JOIN {p}inorm i ON d.item_id = i.item_id
  WHERE NOT EXISTS (SELECT 1 FROM {p}seen s WHERE s.user_id = d.user_id AND s.item_id = d.item_id)),
{p}crank AS (
  SELECT user_id, item_id, round(score, 6) + 0.0 AS score,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(score, 6) DESC, item_id) AS INTEGER) AS rank
  FROM {p}cand),
{p}crecs AS (SELECT user_id, item_id, score, rank FROM {p}crank WHERE rank <= {k})"""


CONTENT = content_ctes()


def metrics_ctes(recs_cte: str, truth_cte: str = "test", ks=(5, 10, 20)) -> str:
    """Per-user metrics ``pu`` from a recs CTE ``(model, user_id, item_id, pos)``."""
    k_list = ", ".join(str(k) for k in ks)
    return f"""ks AS (SELECT CAST(unnest([{k_list}]) AS INTEGER) AS K),
idcg AS (
  SELECT i AS m, sum(1.0 / log2(i + 1)) OVER (ORDER BY i) AS idcg
  FROM generate_series(1, {max(ks)}) t(i)),
truth AS (SELECT DISTINCT user_id, item_id FROM {truth_cte}),
ntruth AS (SELECT user_id, count(*) AS n_truth FROM truth GROUP BY user_id),
elig AS (
  SELECT DISTINCT r.model, r.user_id, nt.n_truth FROM {recs_cte} r JOIN ntruth nt ON r.user_id = nt.user_id),
hits AS (
  SELECT r.model, r.user_id, ks.K, count(*) AS hits, sum(1.0 / log2(r.pos + 1)) AS dcg
  FROM {recs_cte} r JOIN truth t ON r.user_id = t.user_id AND r.item_id = t.item_id
  JOIN ks ON r.pos <= ks.K
  GROUP BY r.model, r.user_id, ks.K),
pu AS (
  SELECT e.model, e.user_id, ks.K, coalesce(h.hits, 0) AS hits, e.n_truth,
         CAST(coalesce(h.hits, 0) AS DOUBLE) / ks.K AS precision,
         CAST(coalesce(h.hits, 0) AS DOUBLE) / e.n_truth AS recall,
         coalesce(h.dcg, 0.0) / ic.idcg AS ndcg
  FROM elig e CROSS JOIN ks
  LEFT JOIN hits h ON h.model = e.model AND h.user_id = e.user_id AND h.K = ks.K
  JOIN idcg ic ON ic.m = least(ks.K, e.n_truth))"""


BOARD_SELECT = """SELECT model, K,
       round(avg(precision), 6) + 0.0 AS precision,
       round(avg(recall), 6) + 0.0 AS recall,
       round(avg(ndcg), 6) + 0.0 AS ndcg,
       count(*) AS n_users_evaluated
FROM pu GROUP BY model, K"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------- catalogue
FEATS = ["popularity", "retail_price", "avg_quantity", "avg_discount", "avg_tax", "n_lines"]
MIN_SUPPORT = 20
MIN_POPULARITY = 25

def raw_ctes(edge: bool = False) -> str:
    """Raw items ``raw`` and with the lineitem aggregates ``rawf``; ``edge`` adds nulls and second copies."""
    name = "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_name END" if edge else "p_name"
    copies = """
  UNION ALL
  SELECT p_partkey, p_name, '[''' || p_brand || ''', ''' || p_type || ''']',
         CAST(p_size AS DOUBLE), p_retailprice, 1
  FROM part WHERE p_partkey % 13 = 0""" if edge else ""
    return f"""raw AS (
  SELECT p_partkey AS item_id, {name} AS name,
         '[''' || p_brand || ''', ''' || p_type || ''']' AS artists,
         CAST(p_size AS DOUBLE) AS popularity, p_retailprice AS retail_price, 0 AS src_order
  FROM part{copies}),
lstats AS (
  SELECT l_partkey AS item_id, avg(l_quantity) AS avg_quantity, avg(l_discount) AS avg_discount,
         avg(l_tax) AS avg_tax, CAST(count(*) AS DOUBLE) AS n_lines
  FROM lineitem GROUP BY l_partkey),
rawf AS (
  SELECT r.*, s.avg_quantity, s.avg_discount, s.avg_tax, s.n_lines
  FROM raw r LEFT JOIN lstats s ON r.item_id = s.item_id)"""


def catalog_ctes(min_support: int = MIN_SUPPORT, min_popularity: float = MIN_POPULARITY, edge: bool = False) -> str:
    complete = " AND ".join([f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATS])
    return raw_ctes(edge) + f""",
s1 AS (
  SELECT * FROM (
    SELECT *, trim(json_extract_string(replace(artists, '''', '"'), '$[0]')) AS artist FROM rawf)
  WHERE artist IS NOT NULL),
s2 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY src_order) AS rn FROM s1)
  WHERE rn = 1),
s3 AS (
  SELECT * FROM s2
  WHERE item_id IS NOT NULL AND name IS NOT NULL AND artist IS NOT NULL AND {complete}),
s4 AS (
  SELECT * FROM s3 WHERE artist IN (
    SELECT artist FROM s3 GROUP BY artist HAVING count(*) >= {min_support})),
s5 AS (SELECT * FROM s4 WHERE popularity >= {min_popularity}),
catalog AS (
  SELECT item_id, name, artist, popularity, retail_price, avg_quantity, avg_discount, avg_tax, n_lines
  FROM s5)"""


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


def std_ctes() -> str:
    """Standardised catalogue features ``std(item_id, <features>)`` (after :func:`catalog_ctes`)."""
    mom = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in FEATS)
    cols = ", ".join(f"CASE WHEN sd_{c} > 0 THEN ({c} - mu_{c}) / sd_{c} ELSE 0.0 END AS {c}" for c in FEATS)
    return f"""mom AS (SELECT {mom} FROM catalog),
std AS (SELECT item_id, {cols} FROM catalog CROSS JOIN mom)"""


def ae_ctes(hidden: int = 128, latent: int = 32) -> str:
    """Fixed-weight autoencoder layers over ``std``: ``ae_x`` (input), ``ae_z`` (latent), ``ae_y`` (output)."""
    n_in = len(FEATS)
    dims = [n_in, hidden, latent, hidden, n_in]
    idx = ", ".join(str(i) for i in range(n_in))
    vals = ", ".join(FEATS)
    out = [f"""ae_x AS (SELECT item_id, unnest([{idx}]) AS i, unnest([{vals}]) AS x FROM std)"""]
    prev = "ae_x"
    names = ["ae_h1", "ae_z", "ae_h3", "ae_y"]
    for L, (fi, fo) in enumerate(zip(dims[:-1], dims[1:]), start=1):
        relu = L < 4
        acc = "sum(w.w * a.x) + b.b"
        val = f"greatest({acc}, 0.0)" if relu else acc
        out.append(f"""ae_w{L} AS (
  SELECT o, i, sin(1.0 + {L} + 0.37 * o + 0.61 * i) / sqrt({fi}) AS w
  FROM generate_series(0, {fo - 1}) t1(o), generate_series(0, {fi - 1}) t2(i)),
ae_b{L} AS (SELECT o, 0.1 * cos({L} + 0.5 * o) AS b FROM generate_series(0, {fo - 1}) t(o)),
{names[L - 1]} AS (
  SELECT a.item_id, w.o AS i, {val} AS x
  FROM {prev} a JOIN ae_w{L} w ON w.i = a.i JOIN ae_b{L} b ON b.o = w.o
  GROUP BY a.item_id, w.o, b.b)""")
        prev = names[L - 1]
    return ",\n".join(out)


#: The collaborative model trains on the training rows whose item is in the prepared catalogue.
CTRAIN = "ctrain AS (SELECT user_id, item_id, play FROM train WHERE item_id IN (SELECT item_id FROM catalog))"
