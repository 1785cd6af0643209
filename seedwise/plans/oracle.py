"""DuckDB SQL for the catalogue queries that have an exact oracle.

The SQL restates each operator's meaning independently of the Spark plan, over
the driver's views (customer, orders, events, documents, labels, embeddings …).
Queries whose values depend on a fitted model have no entry (rows-only check); their
companions check what holds for any right model: ids, totals, sums and means.
"""

from __future__ import annotations

import datetime as dt

from seedwise.constants import GBT_ITERATIONS, GBT_MIN_INSTANCES
from seedwise.plans import catalog as C
from seedwise.plans import profile as P

_CODES = ", ".join(str(c) for c in P.READER_CODES)
_CYC = f"coalesce(contains(cycle, ',{P.CYCLE_TOKEN},'), false)"
_TWO32 = "4294967296.0"
_AS_OF = int(C.AS_OF.strftime("%Y%m%d"))
_YESTERDAY = int((C.AS_OF - dt.timedelta(days=1)).strftime("%Y%m%d"))


def _toks(col: str) -> str:
    return f"list_filter(coalesce(string_split({col}, ','), []::VARCHAR[]), lambda x: x <> '')"


def _wrap(lst: str) -> str:
    return f"CASE WHEN len({lst}) > 0 THEN ',' || array_to_string({lst}, ',') || ',' END"


BASE = f"""
agg AS (
  SELECT o_custkey,
         list_sort(list_distinct(list(month(o_orderdate)))) AS m,
         list_sort(list_distinct(list(o_orderpriority))) AS p,
         list_sort(list_distinct(list(o_orderstatus))) AS s
  FROM orders GROUP BY o_custkey),
profile AS (
  SELECT c.c_custkey AS user_id, {_wrap('a.m')} AS cycle,
         c.c_mktsegment AS segment, c.c_nationkey AS nation,
         {_wrap('a.p')} AS priorities, {_wrap('a.s')} AS statuses,
         CAST(c.c_nationkey AS VARCHAR) AS reader
  FROM customer c LEFT JOIN agg a ON a.o_custkey = c.c_custkey),
seeds AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal > {P.SEED_BALANCE}),
seed_keys AS (SELECT DISTINCT CAST(id AS BIGINT) AS user_id FROM seeds),
flagged AS (
  SELECT *, user_id IN (SELECT user_id FROM seed_keys) AS is_seed, {_CYC} AS cyc FROM profile),
ru AS (SELECT * FROM flagged WHERE nation IN ({_CODES})),
docscore AS (
  SELECT CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + {C.DOC_SCORE_SHIFT}) AS score,
         CAST(l.quality AS DOUBLE) AS label
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
scored AS (
  SELECT user_id,
         round(CAST(len({_toks('cycle')}) * 10 + len({_toks('priorities')}) AS DOUBLE)
               + CAST(nation AS DOUBLE) / 100.0, {C.ROUND}) AS score
  FROM flagged WHERE cyc AND NOT is_seed),
top_scored AS (SELECT user_id, score FROM scored ORDER BY score DESC, user_id ASC LIMIT {C.TOP_K})"""


def _ratio_cte(per_positive: int) -> str:
    return f"""
cnt AS (SELECT count(*) FILTER (WHERE is_seed) AS seeds,
               count(*) FILTER (WHERE cyc AND NOT is_seed) AS others FROM ru),
ratio AS (SELECT least(1.0, coalesce(CASE WHEN others = 0 THEN NULL
          ELSE {float(per_positive)} * CAST(seeds AS DOUBLE) / CAST(others AS DOUBLE) END, 1.0)) AS r FROM cnt),
negatives AS (
  SELECT user_id FROM ru, ratio WHERE cyc AND NOT is_seed AND (r >= 1.0 OR
    ('0x' || substr(md5(CAST(user_id AS VARCHAR) || '#1'), 1, 8))::BIGINT < r * {_TWO32}))"""


def _long(name: str, layout: list[tuple[str, bool, bool]]) -> str:
    """A long table (user_id, pos, col_name, val, tpos, ord_l) for a column layout
    of (column, multi, numeric) triples."""
    parts = []
    for pos, (col, multi, numeric) in enumerate(layout):
        if multi:
            parts.append(
                f"SELECT user_id, {pos} AS pos, '{col}' AS col_name, tok AS val, tpos, NULL::BIGINT AS ord_l "
                f"FROM (SELECT user_id, unnest(ts) AS tok, unnest(range(len(ts))) AS tpos "
                f"FROM (SELECT user_id, {_toks(col)} AS ts FROM profile))")
        else:
            ordl = f"CAST({col} AS BIGINT)" if numeric else "NULL::BIGINT"
            parts.append(f"SELECT user_id, {pos} AS pos, '{col}' AS col_name, CAST({col} AS VARCHAR) AS val, "
                         f"0 AS tpos, {ordl} AS ord_l FROM profile")
    body = "\n  UNION ALL ".join(parts)
    return f"""
{name} AS (
  {body}),
dict_{name} AS (
  SELECT pos, col_name, val,
         CAST(row_number() OVER (PARTITION BY pos ORDER BY ord_l ASC NULLS LAST, val ASC NULLS LAST) - 1 AS INTEGER) AS idx
  FROM (SELECT DISTINCT pos, col_name, val, ord_l FROM {name})),
arity_{name} AS (SELECT pos, col_name, count(*) AS arity FROM dict_{name} GROUP BY pos, col_name),
idx_{name} AS (
  SELECT l.user_id, l.pos, l.col_name, l.tpos, d.idx FROM {name} l
  JOIN dict_{name} d ON d.pos = l.pos AND d.val IS NOT DISTINCT FROM l.val)"""


_L1 = _long("l1", [("segment", True, False), ("nation", False, True),
                   ("priorities", True, False), ("statuses", True, False)])
_L2 = _long("l2", [("segment", False, False), ("nation", False, True),
                   ("priorities", True, False), ("statuses", True, False)])

ONEHOT = _L1 + """,
offs1 AS (SELECT pos, coalesce(sum(arity) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
          FROM arity_l1),
hot1 AS (SELECT user_id, string_agg(CAST(h AS VARCHAR), ',' ORDER BY h) AS feature
         FROM (SELECT DISTINCT i.user_id, CAST(o.o + i.idx AS INTEGER) AS h
               FROM idx_l1 i JOIN offs1 o ON o.pos = i.pos) GROUP BY user_id),
onehot AS (
  SELECT p.user_id, CAST((SELECT sum(arity) FROM arity_l1) AS INTEGER) AS feature_size,
         coalesce(h.feature, '') AS feature, p.cycle, p.reader
  FROM profile p LEFT JOIN hot1 h ON h.user_id = p.user_id)"""

# label sums per slot over the training rows
_SLOTS = """
train AS (SELECT user_id, CAST(1.0 AS DOUBLE) AS y FROM ru WHERE is_seed
          UNION ALL SELECT user_id, CAST(0.0 AS DOUBLE) FROM negatives),
totals AS (SELECT count(*) AS n, sum(y) AS s FROM train),
per_slot AS (
  SELECT slot, count(*) AS n1, sum(y) AS s1 FROM train
  JOIN (SELECT DISTINCT i.user_id, CAST(o.o + i.idx AS INTEGER) AS slot
        FROM idx_l1 i JOIN offs1 o ON o.pos = i.pos) h ON h.user_id = train.user_id
  GROUP BY slot)"""

CATEGORICAL = _L2 + """,
moffs AS (SELECT pos, coalesce(sum(arity) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o
          FROM arity_l2 WHERE pos >= 2),
mhot AS (SELECT DISTINCT i.user_id, CAST(m.o + i.idx AS BIGINT) AS h FROM idx_l2 i JOIN moffs m ON m.pos = i.pos),
slots AS (SELECT unnest(range(0, CAST(sum(arity) AS BIGINT))) AS i FROM arity_l2 WHERE pos >= 2),
mpart AS (
  SELECT p.user_id, string_agg('2:' || CASE WHEN mh.h IS NULL THEN '0' ELSE '1' END, ',' ORDER BY s.i) AS mp
  FROM profile p CROSS JOIN slots s LEFT JOIN mhot mh ON mh.user_id = p.user_id AND mh.h = s.i
  GROUP BY p.user_id),
spart AS (
  SELECT i.user_id, string_agg(CAST(a.arity AS VARCHAR) || ':' || CAST(i.idx AS VARCHAR), ',' ORDER BY i.pos) AS sp
  FROM idx_l2 i JOIN arity_l2 a ON a.pos = i.pos WHERE i.pos < 2 GROUP BY i.user_id),
categorical AS (
  SELECT p.user_id, concat_ws(',', mp.mp, sp.sp) AS feature, p.cycle, p.reader
  FROM profile p LEFT JOIN mpart mp ON mp.user_id = p.user_id LEFT JOIN spart sp ON sp.user_id = p.user_id)"""

PRIO_DICT = f"""
ptoks AS (SELECT user_id, unnest({_toks('priorities')}) AS val FROM profile),
pdict AS (SELECT val, CAST(row_number() OVER (ORDER BY val) - 1 AS INTEGER) AS idx
          FROM (SELECT DISTINCT val FROM ptoks)),
pidx AS (SELECT p.user_id, list_sort(list_distinct(list(d.idx))) AS ix
         FROM profile p LEFT JOIN ptoks t ON t.user_id = p.user_id LEFT JOIN pdict d ON d.val = t.val
         GROUP BY p.user_id)"""


def _single_index(table: str, col: str, keys: list[str]) -> str:
    k = ", ".join(f"t.{c}" for c in keys)
    return f"""
WITH d AS (SELECT v, CAST(row_number() OVER (ORDER BY v ASC NULLS LAST) - 1 AS INTEGER) AS idx
           FROM (SELECT DISTINCT {col} AS v FROM {table}))
SELECT {k}, d.idx FROM {table} t JOIN d ON t.{col} IS NOT DISTINCT FROM d.v"""


def _auc(score_expr: str, out: str) -> str:
    return f"""WITH {BASE},
g AS (SELECT {score_expr} AS s, sum(label) AS p, sum(1 - label) AS n FROM docscore GROUP BY 1),
w AS (SELECT *, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(sum(p * (below + n / 2.0)) / (sum(p) * sum(n)), {C.ROUND}) AS {out} FROM w"""


def _w(body: str, *ctes: str) -> str:
    extra = "".join("," + c for c in ctes)
    return f"WITH {BASE}{extra}\n{body}"


SQL: dict[str, str] = {
    "profile_scan": _w("SELECT user_id, cycle, segment, nation, priorities, statuses, reader FROM profile"),
    "profile_unpivot": _w("\nUNION ALL ".join(
        f"SELECT user_id, {i} AS position, '{c}' AS col_name, CAST({c} AS VARCHAR) AS value FROM profile"
        for i, c in enumerate(P.ONEHOT_COLUMNS))),
    "sql_scan": "SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS value FROM customer WHERE c_nationkey < 10",
    "latest_partition": f"""
WITH e AS (SELECT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS stat_date FROM events
           WHERE event_type = '{C.EVENT_TYPE}' AND value > {C.EVENT_MIN_VALUE}),
m AS (SELECT max(stat_date) AS d FROM e WHERE stat_date < {_AS_OF})
SELECT stat_date, count(*) AS n_rows FROM e WHERE stat_date = (SELECT d FROM m) GROUP BY stat_date""",
    "seed_source": _w("SELECT id FROM seeds"),
    "seed_from_table": _w("SELECT id FROM seeds"),
    "in_list_filter": _w("SELECT user_id, nation FROM ru"),
    "token_membership": _w(f"""SELECT user_id, {_CYC} AS in_cycle,
  coalesce(list_contains({_toks('cycle')}, '{P.CYCLE_TOKEN}'), false) AS in_cycle_tokens FROM profile"""),
    "token_split": _w(f"""SELECT user_id, CAST(len({_toks('priorities')}) AS INTEGER) AS n_tokens,
  array_to_string({_toks('priorities')}, '|') AS tokens FROM profile"""),
    "date_key": """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS today_key,
  CAST(strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS BIGINT) AS yesterday_key FROM orders""",
    "score_threshold_count": _w("SELECT count(*) FILTER (WHERE score > 0.5) AS expansion_size FROM docscore"),
    "seed_users": _w("SELECT user_id FROM flagged WHERE is_seed"),
    "non_seed_users": _w("SELECT user_id FROM flagged WHERE NOT is_seed"),
    "candidates_inclusive": _w("SELECT user_id FROM flagged WHERE cyc"),
    "candidates_exclusive": _w("SELECT user_id FROM flagged WHERE cyc AND NOT is_seed"),
    "population_counts": _w("""SELECT count(*) FILTER (WHERE is_seed) AS seeds,
  count(*) FILTER (WHERE cyc AND NOT is_seed) AS others, count(*) FILTER (WHERE cyc) AS candidates,
  count(*) FILTER (WHERE cyc AND is_seed) AS seeds_in_cycle FROM flagged"""),
    "seed_coverage": _w("""SELECT m.matched, z.seed_size,
  CAST(m.matched AS DOUBLE) / CAST(z.seed_size AS DOUBLE) AS rate
FROM (SELECT count(*) AS matched FROM orders WHERE o_custkey IN (SELECT user_id FROM seed_keys)) m,
     (SELECT count(*) AS seed_size FROM seeds) z"""),
    "sampling_ratio": _w("SELECT r AS ratio FROM ratio", _ratio_cte(10)),
    "negative_sample": _w("SELECT user_id FROM negatives", _ratio_cte(10)),
    "negative_sample_balanced": _w("SELECT user_id FROM negatives", _ratio_cte(1)),
    "hash_split": _w(f"""SELECT user_id,
  CASE WHEN ('0x' || substr(md5(CAST(user_id AS VARCHAR) || '#11'), 1, 8))::BIGINT < 0.5 * {_TWO32}
       THEN 0 ELSE 1 END AS half FROM ru WHERE cyc"""),
    "training_set": _w("""SELECT user_id, CAST(1.0 AS DOUBLE) AS label FROM ru WHERE is_seed
UNION ALL SELECT user_id, CAST(0.0 AS DOUBLE) AS label FROM negatives""", _ratio_cte(10)),
    "gbt_root_split": _w(f"""SELECT slot, n1 AS n_set, n - n1 AS n_unset, round(s1 / n1, 6) AS mean_set,
  round((s - s1) / (n - n1), 6) AS mean_unset, round(gain, 6) AS gain, TRUE AS agrees
FROM (SELECT *, ((s - s1) * (s - s1) / (n - n1) + s1 * s1 / n1 - s * s / n) / n AS gain
      FROM per_slot, totals WHERE n1 >= {GBT_MIN_INSTANCES} AND n - n1 >= {GBT_MIN_INSTANCES} AND n > n1)
ORDER BY gain DESC, slot LIMIT 1""", _ratio_cte(10), ONEHOT, _SLOTS),
    "lr_gradient": _w("""SELECT slot, n1 AS n_set, s1 AS positives, TRUE AS at_optimum FROM per_slot
UNION ALL SELECT -1, n, s, TRUE FROM totals""", _ratio_cte(10), ONEHOT, _SLOTS),
    "leaf_dictionary_agrees": f"""SELECT CAST(range AS INTEGER) AS tree_id, CAST(0 AS BIGINT) AS n_unmatched,
  TRUE AS ascending FROM range({GBT_ITERATIONS})""",
    "category_values": _w("SELECT DISTINCT CAST(nation AS VARCHAR) AS value FROM profile"),
    "token_values": _w(f"SELECT DISTINCT val AS value FROM (SELECT unnest({_toks('priorities')}) AS val FROM profile)"),
    "feature_dictionary": _w("SELECT col_name, val AS value, idx FROM dict_l1", _L1),
    "feature_arity": _w("SELECT col_name, arity FROM arity_l1", _L1),
    "feature_width": _w("SELECT CAST(sum(arity) AS BIGINT) AS width FROM arity_l1", _L1),
    "block_offsets": _w("""SELECT col_name, CAST(coalesce(sum(arity) OVER (ORDER BY pos
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM arity_l1""", _L1),
    "single_index": _single_index("customer", "c_mktsegment", ["c_custkey"]),
    "single_index_int": _single_index("customer", "c_nationkey", ["c_custkey"]),
    "single_index_bigint": _single_index("orders", "o_custkey", ["o_orderkey"]),
    "single_index_double": _single_index("lineitem", "l_discount", ["l_orderkey", "l_linenumber"]),
    "multi_index": _w("SELECT user_id, array_to_string(ix, ',') AS idx FROM pidx", PRIO_DICT),
    "multi_hot": _w("""SELECT user_id, array_to_string(list_transform(range(0, (SELECT count(*) FROM pdict)),
  lambda i: CASE WHEN list_contains(ix, CAST(i AS INTEGER)) THEN 1 ELSE 0 END), ',') AS hot FROM pidx""", PRIO_DICT),
    "onehot_index": _w("""SELECT user_id, col_name, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY tpos) AS idx
FROM idx_l1 GROUP BY user_id, col_name""", _L1),
    "onehot_features": _w("SELECT * FROM onehot", ONEHOT),
    "column_list_source": _w("SELECT * FROM onehot", ONEHOT),
    "onehot_decode": _w("""SELECT user_id, CAST(tok AS INTEGER) AS slot, CAST(1.0 AS DOUBLE) AS value
FROM (SELECT user_id, unnest(string_split(feature, ',')) AS tok FROM onehot) WHERE tok <> ''""", ONEHOT),
    "feature_size_check": _w("SELECT count(DISTINCT feature_size) AS n_widths, max(feature_size) AS width FROM onehot", ONEHOT),
    "preview": _w(f"SELECT user_id, feature FROM onehot ORDER BY user_id LIMIT {C.PREVIEW_ROWS}", ONEHOT),
    "categorical_features": _w("SELECT * FROM categorical", CATEGORICAL),
    "categorical_render": _w("SELECT user_id, feature FROM categorical", CATEGORICAL),
    "confusion_matrix": _w("""SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
  count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
  count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn,
  count(*) FILTER (WHERE score < 0.5 AND label = 0) AS tn FROM docscore"""),
    "precision_recall": _w(f"""SELECT round(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), {C.ROUND}) AS precision,
  round(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), {C.ROUND}) AS recall
FROM (SELECT count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp,
             count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
             count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn FROM docscore)"""),
    "auc_raw": _auc("score", "auc"),
    "auc_binarised": _auc("CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END", "auc_binarised"),
    "topk_scores": _w("SELECT user_id, score FROM top_scored"),
    "all_ranked": _w("SELECT user_id, score, row_number() OVER (ORDER BY score DESC, user_id ASC) AS rank FROM scored"),
    "array_to_vector_rows": f"""SELECT vec_id, CAST(i AS INTEGER) AS position,
  round(CAST(embedding[i + 1] AS DOUBLE), {C.ROUND}) AS value
FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM embeddings)""",
    "onehot_features_wide": """
WITH k AS (SELECT o_custkey AS v, row_number() OVER (ORDER BY o_custkey) - 1 AS i
           FROM (SELECT DISTINCT o_custkey FROM orders)),
d AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i
      FROM (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS v FROM orders)),
n AS (SELECT (SELECT count(*) FROM k) AS nk, (SELECT count(*) FROM d) AS nd)
SELECT o.o_orderkey AS user_id, CAST(n.nk + n.nd AS INTEGER) AS feature_size,
       CAST(k.i AS VARCHAR) || ',' || CAST(n.nk + d.i AS VARCHAR) AS feature
FROM orders o, n, k, d WHERE k.v = o.o_custkey AND d.v = strftime(o.o_orderdate, '%Y%m%d')""",
    "lr_mean_score": _w(f"""SELECT round(avg(label), {C.ROUND}) AS mean_label, true AS score_agrees FROM
  (SELECT 1.0 AS label FROM ru WHERE is_seed UNION ALL SELECT 0.0 AS label FROM negatives)""", _ratio_cte(10)),
    "training_report_totals": _w("""SELECT (SELECT count(*) FROM ru WHERE is_seed) AS positives,
  (SELECT count(*) FROM negatives) AS negatives""", _ratio_cte(10)),
    "leaf_onehot_hot": _w(f"SELECT user_id, CAST({GBT_ITERATIONS} AS INTEGER) AS n_hot FROM ru WHERE cyc"),
    "leaf_sink_users": _w(f"SELECT user_id, CAST({_AS_OF} AS BIGINT) AS stat_date FROM ru WHERE cyc"),
    "leaf_text_agrees": _w(f"""SELECT user_id, CAST({_AS_OF} AS BIGINT) AS stat_date,
  CAST({GBT_ITERATIONS} AS INTEGER) AS n_hot, TRUE AS agrees FROM ru WHERE cyc"""),
    "lr_hard_agrees": _w("SELECT user_id, TRUE AS agrees FROM ru WHERE cyc AND NOT is_seed"),
    "feature_sink_roundtrip": _w(f"""SELECT *, CAST({_AS_OF} AS BIGINT) AS stat_date FROM onehot
UNION ALL SELECT *, CAST({_YESTERDAY} AS BIGINT) AS stat_date FROM onehot""", ONEHOT),
    "score_sink_roundtrip": _w(f"SELECT user_id, score, CAST({_YESTERDAY} AS BIGINT) AS stat_date FROM scored"),
    "score_file_roundtrip": _w("SELECT user_id, score FROM top_scored"),
    "id_file_roundtrip": _w("SELECT CAST(user_id AS VARCHAR) AS user_id FROM top_scored"),
}
for _name in ("expand_by_trees_ids", "expand_by_logistic_ids", "expand_from_table_ids"):
    SQL[_name] = _w("SELECT user_id FROM ru WHERE cyc AND NOT is_seed")
SQL["gbt_roundtrip_equal"] = _w("SELECT user_id FROM ru")
SQL["tree_scores_add_up"] = _w("SELECT user_id FROM ru WHERE cyc")
SQL["latest_partition_table"] = SQL["latest_partition"]
