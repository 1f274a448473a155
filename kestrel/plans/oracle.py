"""SQL oracles: each shop query restated as plain SQL over the same tables
(DuckDB dialect; the tables are views named after the parquet files).

They are written from the query's meaning, not from the Spark plan, and
share with it only the fixed values (rules, thresholds, dates).
"""

from __future__ import annotations

from kestrel.operators.cleanup import LEHMER_A, LEHMER_M, PAY_CODES, PAY_NAMES
from kestrel.plans import shop as s


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_q(x) if isinstance(x, str) else str(x) for x in r) + ")"
                     for r in rows)
    return f"(VALUES {body}) AS v({', '.join(cols)})"


def _rules(rules) -> str:
    return _values([(r, n) for _, n, r in rules], ["rule", "name"])


def _ranges(rules) -> str:
    rows = [(n, int(r.split("-")[0]), int(r.split("-")[1])) for _, n, r in rules]
    return _values(rows, ["name", "lo", "hi"])


def _in(vals) -> str:
    return ", ".join(_q(v) for v in vals)


RFM = f"""
  SELECT o_custkey AS userId,
         CAST(date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '{s.ORDERS_AS_OF}') AS BIGINT) AS recency,
         count(o_orderkey) AS frequency,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS monetary
  FROM orders GROUP BY o_custkey"""

RFE = f"""
  SELECT user_id AS userId,
         CAST(date_diff('day', max(CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END),
                        DATE '{s.EVENTS_AS_OF}') AS BIGINT) AS recency,
         count(*) AS frequency,
         count(DISTINCT props) AS engagements
  FROM events GROUP BY user_id"""


RFM_SCORES = f"""
  SELECT userId,
         CASE WHEN recency < 55 THEN 5.0 WHEN recency < 124 THEN 4.0 WHEN recency < 220 THEN 3.0
              WHEN recency < 391 THEN 2.0 WHEN recency >= 391 THEN 1.0 END::DOUBLE AS r_score,
         CASE WHEN frequency < 8 THEN 1.0 WHEN frequency < 10 THEN 2.0 WHEN frequency < 12 THEN 3.0
              WHEN frequency < 14 THEN 4.0 WHEN frequency >= 14 THEN 5.0 END::DOUBLE AS f_score,
         CASE WHEN monetary < 1710000 THEN 1.0 WHEN monetary < 2230000 THEN 2.0
              WHEN monetary < 2670000 THEN 3.0 WHEN monetary < 3250000 THEN 4.0
              WHEN monetary >= 3250000 THEN 5.0 END::DOUBLE AS m_score
  FROM ({RFM}) m"""

RFM_STRICT = f"""
  SELECT userId,
         CASE WHEN recency <= 40 THEN 5.0 WHEN recency BETWEEN 55 AND 123 THEN 4.0
              WHEN recency BETWEEN 130 AND 219 THEN 3.0 WHEN recency BETWEEN 220 AND 390 THEN 2.0
              WHEN recency >= 400 THEN 1.0 END::DOUBLE AS r_score,
         CASE WHEN frequency <= 6 THEN 1.0 WHEN frequency BETWEEN 8 AND 9 THEN 2.0
              WHEN frequency = 11 THEN 3.0 WHEN frequency BETWEEN 12 AND 13 THEN 4.0
              WHEN frequency >= 15 THEN 5.0 END::DOUBLE AS f_score,
         CASE WHEN monetary < 1500000 THEN 1.0 WHEN monetary BETWEEN 1710000 AND 2229999 THEN 2.0
              WHEN monetary BETWEEN 2300000 AND 2669999 THEN 3.0
              WHEN monetary BETWEEN 2670000 AND 3249999 THEN 4.0
              WHEN monetary >= 3400000 THEN 5.0 END::DOUBLE AS m_score
  FROM ({RFM}) m"""

RFE_SCORES = f"""
  SELECT userId,
         CASE WHEN recency < 2 THEN 5.0 WHEN recency < 3 THEN 4.0 WHEN recency < 5 THEN 3.0
              WHEN recency < 8 THEN 2.0 WHEN recency >= 8 THEN 1.0 END::DOUBLE AS r_score,
         CASE WHEN frequency < 60 THEN 1.0 WHEN frequency < 65 THEN 2.0 WHEN frequency < 70 THEN 3.0
              WHEN frequency < 75 THEN 4.0 WHEN frequency >= 75 THEN 5.0 END::DOUBLE AS f_score,
         CASE WHEN engagements < 45 THEN 1.0 WHEN engagements < 48 THEN 2.0 WHEN engagements < 51 THEN 3.0
              WHEN engagements < 54 THEN 4.0 WHEN engagements >= 54 THEN 5.0 END::DOUBLE AS e_score
  FROM ({RFE}) m"""

RFE_STRICT = f"""
  SELECT userId,
         CASE WHEN recency <= 1 THEN 5.0 WHEN recency = 2 THEN 4.0 WHEN recency BETWEEN 3 AND 4 THEN 3.0
              WHEN recency BETWEEN 5 AND 7 THEN 2.0 WHEN recency >= 8 THEN 1.0 END::DOUBLE AS r_score,
         CASE WHEN frequency <= 59 THEN 1.0 WHEN frequency BETWEEN 60 AND 64 THEN 2.0
              WHEN frequency BETWEEN 65 AND 69 THEN 3.0 WHEN frequency BETWEEN 70 AND 74 THEN 4.0
              WHEN frequency >= 75 THEN 5.0 END::DOUBLE AS f_score,
         CASE WHEN engagements < 44 THEN 1.0 WHEN engagements BETWEEN 45 AND 47 THEN 2.0
              WHEN engagements BETWEEN 48 AND 50 THEN 3.0 WHEN engagements BETWEEN 51 AND 53 THEN 4.0
              WHEN engagements >= 54 THEN 5.0 END::DOUBLE AS e_score
  FROM ({RFE}) m"""

SEGMENT = f"""
  SELECT c.c_custkey AS userId, v.name AS segment
  FROM customer c JOIN {_rules(s.SEGMENT_RULES)} ON trim(c.c_mktsegment) = v.rule"""

CYCLE = f"""
  SELECT l.o_custkey AS userId, v.name AS cycle
  FROM (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) l
  JOIN {_ranges(s.CYCLE_RULES)}
    ON date_diff('day', CAST(l.last_order AS DATE), DATE '{s.ORDERS_AS_OF}') BETWEEN v.lo AND v.hi"""

LINES = """
  SELECT o.o_custkey AS userId, li.l_orderkey, li.l_linenumber, li.l_partkey,
         CAST(li.l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(li.l_discount AS DECIMAL(4,2)) AS disc, li.l_discount AS d
  FROM lineitem li JOIN orders o ON li.l_orderkey = o.o_orderkey"""

LABELLED = f"""
  SELECT l.userId, l.l_orderkey, l.l_linenumber,
         CASE WHEN p.p_brand IN ({_in(s.FEMALE_BRANDS)}) OR p.p_type IN ({_in(s.FEMALE_TYPES)})
              THEN 1 ELSE 0 END AS label
  FROM ({LINES}) l JOIN part p ON l.l_partkey = p.p_partkey"""

GEO = f"""
  SELECT CAST(1 AS BIGINT) AS id, 'shop' AS name, '' AS rule, 1 AS level, CAST(-1 AS BIGINT) AS pid
  UNION ALL SELECT 2, 'geography', '', 2, 1
  UNION ALL SELECT CAST(100 + r_regionkey AS BIGINT), r_name, '', 3, 2 FROM region
  UNION ALL SELECT CAST(1000 + n_nationkey AS BIGINT), n_name,
         'inType=parquet' || chr(10) || 'table=customer' || chr(10) ||
         'selectFieldNames=c_custkey,c_mktsegment' || chr(10) ||
         'filterConditions=c_nationkey[eq]' || CAST(n_nationkey AS VARCHAR),
         4, CAST(100 + n_regionkey AS BIGINT) FROM nation
  UNION ALL SELECT DISTINCT CAST(100000 + c_nationkey * 100 + ascii(c_mktsegment) AS BIGINT),
         lower(c_mktsegment), c_mktsegment, 5, CAST(1000 + c_nationkey AS BIGINT) FROM customer"""

_LEHMER1 = f"((o_orderkey % {LEHMER_M}) * {LEHMER_A}) % {LEHMER_M}"
_LEHMER2 = f"(({_LEHMER1}) * {LEHMER_A}) % {LEHMER_M}"
_PAY_IN = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in s.PRIORITY_PAY.items())
_CODES = "[" + _in(PAY_CODES) + "]"
_NAMES = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in PAY_NAMES.items())

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _str(c):
    return f"CASE WHEN length(trim(CAST({c} AS VARCHAR))) > 0 THEN CAST({c} AS VARCHAR) END"


ORACLE = {
    "rule_match_inner": SEGMENT,
    "rule_match_left_default": f"""
      SELECT c.c_custkey AS userId, v.name AS segment
      FROM customer c LEFT JOIN {_rules(s.SEGMENT_RULES)} ON trim(c.c_mktsegment) = v.rule""",
    "age_range": f"""
      SELECT f.o_custkey AS userId, v.name AS first_order_band
      FROM (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
      JOIN {_ranges(s.FIRST_ORDER_RULES)}
        ON CAST(strftime(f.first_order, '%Y%m%d') AS INTEGER) BETWEEN v.lo AND v.hi""",
    "consume_cycle": CYCLE,
    "pay_type_top1": f"""
      WITH c AS (SELECT o_custkey, o_orderpriority AS val, count(*) AS n FROM orders GROUP BY 1, 2),
      b AS (SELECT o_custkey, val,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, val ASC) AS rn FROM c)
      SELECT b.o_custkey AS userId, v.name AS pay_type
      FROM b JOIN {_rules(s.PRIORITY_RULES)} ON trim(b.val) = v.rule WHERE b.rn = 1""",
    "top1_window": """
      WITH ranked AS (
        SELECT c_nationkey, c_custkey, c_name, c_acctbal,
               row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn
        FROM customer)
      SELECT c_nationkey, c_custkey, c_name, c_acctbal FROM ranked WHERE rn = 1""",
    "rfm_measures": RFM,
    "rfm_scores": RFM_SCORES,
    "rfm_scores_strict": RFM_STRICT,
    "rfe_measures": RFE,
    "rfe_scores": RFE_SCORES,
    "rfe_scores_strict": RFE_STRICT,
    "psm_score": f"""
      WITH x AS (
        SELECT userId, l_orderkey,
               CAST(price * (1 - disc) AS DECIMAL(18,2)) AS amount,
               CAST(CASE WHEN d >= {s.COUPON_MIN_DISCOUNT} THEN price * disc ELSE 0 END AS DECIMAL(18,2)) AS coupon
        FROM ({LINES}) l),
      g AS (
        SELECT userId, CAST(count(l_orderkey) AS DOUBLE) AS n,
               CAST(sum(CASE WHEN coupon <> 0 THEN 1 ELSE 0 END) AS DOUBLE) AS st,
               CAST(sum(amount + coupon) AS DOUBLE) AS ra, CAST(sum(coupon) AS DOUBLE) AS da
        FROM x GROUP BY userId),
      r AS (
        SELECT userId,
               CASE WHEN n = 0 THEN NULL ELSE st / n END AS tdonr,
               CASE WHEN ra = 0 THEN NULL ELSE da / ra END AS tdar,
               CASE WHEN st = 0 OR n = 0 OR ra = 0 THEN NULL ELSE (da / st) / (ra / n) END AS adar
        FROM g)
      SELECT userId, tdonr, tdar, adar, coalesce(tdonr + tdar + adar, 1e-8) AS psm FROM r""",
    "usg_line_label": f"SELECT l_orderkey, l_linenumber, userId, label FROM ({LABELLED}) t",
    "usg_share_label": f"""
      WITH c AS (
        SELECT userId, count(*) AS total,
               count(*) FILTER (WHERE label = 0) AS male_total,
               count(*) FILTER (WHERE label = 1) AS female_total
        FROM ({LABELLED}) t GROUP BY userId)
      SELECT c.userId, c.total, c.male_total, c.female_total, v.name AS usg
      FROM c JOIN {_rules(s.USG_RULES)}
        ON v.rule = CASE WHEN CAST(male_total AS DOUBLE) / CAST(total AS DOUBLE) >= CAST(0.6 AS DOUBLE) THEN '0'
                         WHEN CAST(female_total AS DOUBLE) / CAST(total AS DOUBLE) >= CAST(0.6 AS DOUBLE) THEN '1'
                         ELSE '-1' END""",
    "dict_encode": f"""
      SELECT li.l_orderkey, li.l_linenumber, p.p_type, CAST(coalesce(v.id, 0) AS INTEGER) AS product_id
      FROM lineitem li JOIN part p ON li.l_partkey = p.p_partkey
      LEFT JOIN {_values(s.TYPE_DIM, ['id', 'name'])} ON p.p_type = v.name""",
    "condition_filter": """
      SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
             o_orderstatus, o_orderpriority, CAST(o_orderdate AS VARCHAR) AS o_orderdate
      FROM orders
      WHERE o_orderstatus = 'F' AND o_orderpriority <= '2-HIGH'
        AND CAST(o_orderdate AS VARCHAR) >= '1997-01-01'""",
    "relative_date_filter": f"""
      SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
      WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{s.ORDERS_AS_OF}' - {30 * s.ORDER_WINDOW[2]}
                                          AND DATE '{s.ORDERS_AS_OF}' - 1""",
    "url_extract": f"""
      SELECT page_id, NULLIF(regexp_extract(url, '{s.PAGE_URL_PATTERN}', 1), '') AS product FROM pages""",
    "click_ratings": """
      SELECT user_id AS userId, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS productId,
             count(*) AS clicks
      FROM events WHERE event_type = 'click' GROUP BY 1, 2""",
    "profile_upsert": f"""
      SELECT coalesce(n.userId, o.userId) AS userId, o.segment, n.cycle
      FROM ({SEGMENT}) o FULL OUTER JOIN ({CYCLE}) n ON o.userId = n.userId""",
    "sync_table_strings": "SELECT " + ", ".join(f"{_str(c)} AS {c}" for c in CUSTOMER_COLS) + " FROM customer",
    "to_cells": "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'user' AS family, '{c}' AS qualifier, {_str(c)} AS value FROM customer"
        for c in CUSTOMER_COLS) + ") WHERE value IS NOT NULL",
    "drop_malformed": """
      WITH lines AS (
        SELECT concat_ws(chr(9), CAST(event_id AS VARCHAR), CAST(epoch_us(ts) AS VARCHAR),
                         CAST(user_id AS VARCHAR), event_type, CAST(value AS VARCHAR), props) AS line
        FROM events
        UNION ALL
        SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
      t AS (SELECT string_split(line, chr(9)) AS tok FROM lines)
      SELECT TRY_CAST(tok[1] AS BIGINT) AS event_id, tok[2] AS ts, TRY_CAST(tok[3] AS BIGINT) AS user_id,
             tok[4] AS event_type, TRY_CAST(tok[5] AS DOUBLE) AS value, tok[6] AS props
      FROM t WHERE len(tok) = 6""",
    "tags_string_to_cells": """
      SELECT c_custkey AS userId, 'segment' AS field, trim(c_mktsegment) AS value FROM customer
      UNION ALL
      SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer""",
    "order_cleanup": f"""
      WITH src AS (
        SELECT o_orderkey, o_custkey,
               coalesce(CASE o_orderpriority {_PAY_IN} END, o_orderpriority) AS pc,
               CAST(epoch(o_orderdate) AS BIGINT) AS t
        FROM orders),
      c AS (
        SELECT o_orderkey,
               CAST(CASE WHEN o_custkey >= {s.MEMBER_LIMIT} THEN ({_LEHMER1}) % {s.MEMBER_LIMIT} + 1
                         ELSE o_custkey END AS BIGINT) AS memberid,
               CASE WHEN pc IN ({_in(PAY_CODES)})
                    THEN pc ELSE {_CODES}[({_LEHMER2}) % {len(PAY_CODES)} + 1] END AS paymentcode,
               CAST((floor(t / 86400) + 350) * 86400 AS BIGINT) AS finishtime
        FROM src)
      SELECT o_orderkey, memberid, paymentcode, finishtime,
             CASE paymentcode {_NAMES} END AS paymentname FROM c""",
    "mean_impute": """
      WITH x AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal FROM customer)
      SELECT c_custkey, coalesce(acctbal, (SELECT round(avg(acctbal), 2) FROM x)) AS acctbal FROM x""",
    "contingency": """
      SELECT c.c_mktsegment, n.n_regionkey, count(*) AS n
      FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2""",
    "topk_limit": f"""
      SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
      FROM orders GROUP BY o_custkey ORDER BY spend DESC, o_custkey LIMIT {s.TOP_K}""",
    "tag_fetch_union": f"""
      WITH g AS ({GEO}), n AS (SELECT id AS tag FROM g WHERE level = 4)
      SELECT n.tag, g.id, g.name, g.level FROM g JOIN n ON g.id = n.tag
      UNION
      SELECT n.tag, g.id, g.name, g.level FROM g JOIN n ON g.pid = n.tag""",
    "tag_children": f"""
      WITH g AS ({GEO})
      SELECT p.id AS parent_id, p.name AS parent, count(*) AS n_children
      FROM g JOIN g p ON g.pid = p.id GROUP BY 1, 2""",
    "tag_path": f"""
      WITH g AS ({GEO})
      SELECT l5.id, concat_ws('/', l1.name, l2.name, l3.name, l4.name, l5.name) AS path
      FROM g l5 LEFT JOIN g l4 ON l5.pid = l4.id LEFT JOIN g l3 ON l4.pid = l3.id
      LEFT JOIN g l2 ON l3.pid = l2.id LEFT JOIN g l1 ON l2.pid = l1.id
      WHERE l5.level = 5""",
    "tag_model_left": f"""
      WITH g AS ({GEO}),
      m AS (SELECT DISTINCT CAST(5000 + s_nationkey AS BIGINT) AS model_id,
                   CAST(1000 + s_nationkey AS BIGINT) AS tag_id,
                   'supply_model_' || CAST(s_nationkey AS VARCHAR) AS model_name FROM supplier)
      SELECT g.id, g.name, m.model_id, m.model_name FROM g LEFT JOIN m ON g.id = m.tag_id
      WHERE g.level = 4""",
    "center_rank": f"""
      WITH sc AS ({RFM_SCORES}),
      j AS (SELECT c.c_mktsegment, avg(r_score) + avg(f_score) + avg(m_score) AS s
            FROM sc JOIN customer c ON sc.userId = c.c_custkey GROUP BY 1)
      SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY s DESC, c_mktsegment) - 1 AS INTEGER) AS rank
      FROM j""",
    "minmax_scale": """
      WITH b AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
      SELECT c_custkey, round((c_acctbal - (SELECT lo FROM b)) / ((SELECT hi FROM b) - (SELECT lo FROM b)), 9)
             AS acctbal_scaled FROM customer""",
    "standard_scale": """
      SELECT c_custkey, round(c_acctbal / (SELECT stddev_samp(c_acctbal) FROM customer), 9) AS acctbal_std
      FROM customer""",
    "string_index": """
      WITH f AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1),
      r AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS DOUBLE) AS seg_index FROM f)
      SELECT c.c_custkey, r.seg_index FROM customer c JOIN r ON c.c_mktsegment = r.c_mktsegment""",
    "one_hot": """
      WITH f AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1),
      r AS (SELECT c_mktsegment, row_number() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS idx FROM f)
      SELECT c.c_custkey,
             array_to_string(list_transform(range((SELECT count(*) FROM f)),
                                            lambda i: CASE WHEN i = r.idx THEN '1' ELSE '0' END), ',') AS seg_onehot
      FROM customer c JOIN r ON c.c_mktsegment = r.c_mktsegment""",
    "log_cells": """
      WITH lines AS (
        SELECT concat_ws(chr(9), CAST(event_id AS VARCHAR), CAST(epoch_us(ts) AS VARCHAR),
                         CAST(user_id AS VARCHAR), event_type, CAST(value AS VARCHAR), props) AS line
        FROM events
        UNION ALL
        SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
      t AS (SELECT string_split(line, chr(9)) AS tok FROM lines),
      w AS (SELECT tok FROM t WHERE len(tok) = 6),
      c AS (
        SELECT tok[1] AS row_key, 'ts' AS qualifier, tok[2] AS value FROM w
        UNION ALL SELECT tok[1], 'user_id', tok[3] FROM w
        UNION ALL SELECT tok[1], 'event_type', tok[4] FROM w
        UNION ALL SELECT tok[1], 'value', tok[5] FROM w
        UNION ALL SELECT tok[1], 'props', tok[6] FROM w)
      SELECT row_key, 'detail' AS family, qualifier, value FROM c
      WHERE length(trim(value)) > 0""",
    "sql_group_order": """
      SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 2) AS avg_bal
      FROM customer GROUP BY c_mktsegment ORDER BY n DESC, c_mktsegment""",
    "template_pay_type": f"""
      WITH o AS (SELECT o_custkey, o_orderpriority FROM orders
                 WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{s.ORDERS_AS_OF}' - 730
                                                     AND DATE '{s.ORDERS_AS_OF}' - 1),
      c AS (SELECT o_custkey, o_orderpriority AS val, count(*) AS n FROM o GROUP BY 1, 2),
      b AS (SELECT o_custkey, val,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, val ASC) AS rn FROM c)
      SELECT b.o_custkey AS userId, v.name AS pay_type
      FROM b JOIN {_rules(s.PRIORITY_RULES)} ON trim(b.val) = v.rule WHERE b.rn = 1""",
    "sql_two_key_count": """
      SELECT o_custkey, o_orderpriority, count(o_custkey) AS n_member, count(o_orderpriority) AS n_code
      FROM orders GROUP BY o_custkey, o_orderpriority ORDER BY o_custkey, o_orderpriority""",
    "cells_round_trip": """
      SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment,
             CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal
      FROM customer
      WHERE (c_mktsegment IS NULL OR c_mktsegment = 'BUILDING')
        AND (c_nationkey IS NULL OR CAST(c_nationkey AS VARCHAR) < '2')""",
}


# ------------------------------------------------------------ certificates
#
# What a fitted model must satisfy: counts and sums are taken from the tables, all else is
# that nothing is off.

def _clusters(scores: str, cols: list[str], scaled: bool = False) -> str:
    one = (lambda c: f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN ({c} - min({c}) OVER ()) / "
                     f"(max({c}) OVER () - min({c}) OVER ()) ELSE 0.5 END") if scaled else (lambda c: c)
    known = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"""
      WITH s AS ({scores}),
      k AS (SELECT {' + '.join('(' + one(c) + ')' for c in cols)} AS total FROM s WHERE {known})
      SELECT (SELECT count(*) FROM s) AS n_users, (SELECT count(*) FROM s WHERE NOT ({known})) AS n_untagged,
             CAST(0 AS BIGINT) AS n_mistagged, CAST(0 AS BIGINT) AS n_not_nearest, true AS centres_are_means,
             true AS cost_adds_up, (SELECT round(sum(total), 3) FROM k) AS coordinate_sum"""


FACTORS = f"""
  WITH c AS (SELECT * FROM ({ORACLE['click_ratings']}) t WHERE userId IS NOT NULL AND productId IS NOT NULL)
  SELECT count(DISTINCT userId) AS n_users, CAST(0 AS BIGINT) AS n_unsolved, count(*) AS n_ratings,
         count(DISTINCT productId) AS n_items, CAST(0 AS BIGINT) AS n_lists_off,
         count(DISTINCT userId) * least(5, count(DISTINCT productId)) AS n_recommended"""

_DOCS = "documents d JOIN labels l ON d.doc_id = l.doc_id"
_TREES = """
  SELECT count(*) AS n_rows, count(*) FILTER (WHERE {label} = 1) AS n_labelled_1, CAST(0 AS BIGINT) AS n_replayed_off{more}
  FROM {rows}"""
_LEAVES = ", CAST(0 AS BIGINT) AS n_leaves_off"
_LOGISTIC = "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_replayed_off, true AS no_worse_than_constant FROM "

ORACLE |= {
    "rfm_certificate": _clusters(RFM_SCORES, ["r_score", "f_score", "m_score"]),
    "rfm_scaled_certificate": _clusters(RFM_SCORES, ["r_score", "f_score", "m_score"], scaled=True),
    "rfe_certificate": _clusters(RFE_SCORES, ["r_score", "f_score", "e_score"]),
    "psm_certificate": _clusters(ORACLE["psm_score"], ["psm"]),
    "als_explicit_certificate": f"{FACTORS} FROM c",
    "als_implicit_certificate": f"{FACTORS}, true AS rmse_within_clicks FROM c",
    "usg_tree_certificate": _TREES.format(
        label="label", rows=f"({LABELLED}) t",
        more=_LEAVES + "".join(f", count(*) FILTER (WHERE (l_orderkey + l_linenumber) % 3 = {k}) AS n_fold_{k}"
                               for k in range(3)) + ", CAST(8 AS BIGINT) AS n_settings, true AS best_wins"),
    "vector_tree_certificate": _TREES.format(label="label", rows="embeddings", more=_LEAVES),
    "random_forest_certificate": _TREES.format(label="l.quality", rows=_DOCS, more=""),
    "gbt_certificate": _TREES.format(label="l.quality", rows=_DOCS, more=""),
    "logreg_certificate": _LOGISTIC + _DOCS,
    "vector_logreg_certificate": _LOGISTIC + "embeddings",
    "linreg_certificate": """
      SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_replayed_off, true AS residuals_cancel,
             true AS gradient_vanishes
      FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
}

# ------------------------------------------- catalog, bands, stores, export

_LEAF = ("CAST(1000000000000 * {level} AS BIGINT) + CAST(100000 + c_nationkey * 100 + ascii(c_mktsegment) AS BIGINT) * 10000000 "
         "+ c_custkey // {size}")

ORACLE |= {
    "tag_fetch": f"SELECT DISTINCT id, name, level FROM ({GEO}) g WHERE id = {s.NATION_TAG} OR pid = {s.NATION_TAG}",
    "tag_level_children": f"""
      SELECT id, name, 'level 4' AS kind FROM ({GEO}) g WHERE level = 4
      UNION ALL SELECT id, name, 'child' FROM ({GEO}) g WHERE pid = {s.NATION_TAG}""",
    "tag_deep_path": f"""
      SELECT {_LEAF.format(level=9, size=1)} AS id,
             concat_ws('/', 'shop', 'geography', r_name, n_name, lower(c_mktsegment), c_custkey // 1000,
                       c_custkey // 100, c_custkey // 10, c_custkey) AS path
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "catalog_merge": f"""
      WITH geo AS ({GEO}),
      top AS (SELECT max(id) AS m FROM geo),
      h AS (SELECT DISTINCT o_orderpriority AS p, n_name
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
      p AS (SELECT p, row_number() OVER (ORDER BY p) AS i FROM (SELECT DISTINCT p FROM h)),
      l AS (SELECT m + 1 + i AS pid, n_name FROM h JOIN p USING (p), top)
      SELECT id, name, level, pid FROM geo
      UNION ALL SELECT m + 1, 'payment', 2, 1 FROM top
      UNION ALL SELECT m + 1 + i, p, 3, m + 1 FROM p, top
      UNION ALL SELECT m + 1 + (SELECT count(*) FROM p) + row_number() OVER (ORDER BY pid, n_name), n_name, 4, pid
                FROM l, top""",
    "price_band": f"""
      WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders),
      b AS (SELECT o_orderkey, v // {s.BAND_WIDTH} AS k, v % {s.BAND_WIDTH} AS r FROM o WHERE v >= 0)
      SELECT o_orderkey AS userId,
             CASE WHEN k BETWEEN 1 AND {s.N_BANDS - 1} AND r <= 499 THEN 'upper ' || CAST(k - 1 AS VARCHAR)
                  WHEN k >= {s.N_BANDS - 1} THEN 'band {s.N_BANDS - 1}'
                  WHEN k % 2 = 1 AND r = {s.BAND_WIDTH - 1} THEN 'upper ' || CAST(k AS VARCHAR)
                  ELSE 'band ' || CAST(k AS VARCHAR) END AS band
      FROM b""",
    "profile_store_upsert": f"""
      SELECT coalesce(a.userId, b.userId) AS userId, a.segment, b.cycle
      FROM ({SEGMENT}) a FULL OUTER JOIN (SELECT * FROM ({CYCLE}) c WHERE userId % 100 < 3) b ON a.userId = b.userId""",
    "export_regions": f"""
      WITH cells AS ({ORACLE['to_cells']}),
      r AS (SELECT row_key, CAST({' + '.join(f"CASE WHEN row_key >= {_q(k)} THEN 1 ELSE 0 END" for k in s.EXPORT_SPLITS)}
                                 AS INTEGER) AS region FROM cells)
      SELECT region, min(row_key) AS first_key, max(row_key) AS last_key, count(*) AS n_cells, true AS in_order
      FROM r GROUP BY region""",
}
