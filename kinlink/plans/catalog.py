"""Operators applied to the shared test tables (TPC-H-like star schema).

The test tables are not administrative records, so each operator runs on a
table of the same shape; the mapping is stated per query.  Every query
reads whole tables.  ``SQL`` holds an independent DuckDB formulation of
each query for the correctness gate.  Dates are rendered as ISO text in
both so results compare as values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import recode as rc
from ..operators import aggregates as ag
from ..operators import dedup, graph, joins, linkage, reshape, spells
from . import agencies
from ..sources.readers import stack_by_name

# lineitem has no row id; this tuple is unique at every scale factor
LI_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
LI_TIE = LI_ORDER[1:]
_LI_TIE_SQL = "(" + ", ".join(LI_TIE) + ")"
_LI_TIE_DESC = ", ".join(c + " DESC" for c in LI_TIE)

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd")


# --------------------------------------------------------------- S3 / U1 --
@query("union_by_name", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment, 0 AS src_ord FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       1 AS src_ord FROM supplier
""")
def q_union_by_name(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"), F.lit(0).alias("src_ord"))
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
        F.lit(1).alias("src_ord"))
    return stack_by_name([c, s])


# -------------------------------------------------------------------- D1 --
@query("dedup_keep_last", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
""")
def q_dedup_keep_last(spark, d):
    return dedup.keep_last(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"])


# -------------------------------------------------------------------- P3 --
@query("recode_unknown", """
SELECT p_partkey, p_name, p_brand, p_type,
       CASE WHEN p_size IN (8, 9, 99) THEN NULL ELSE p_size END AS p_size, p_retailprice
FROM part
""")
def q_recode_unknown(spark, d):
    return rc.recode_unknown(table(spark, d, "part"), ["p_size"])


# --------------------------------------------------------------- P4 / P5 --
_DATE_TEXT_SQL = """CASE WHEN o_orderstatus = 'P' THEN 'NA'
            WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') || 'x'
            WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%Y/%m/%d')
            ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


def _date_text() -> Column:
    dash = F.date_format("o_orderdate", "yyyy-MM-dd")
    return (F.when(F.col("o_orderstatus") == "P", F.lit("NA"))
             .when(F.col("o_orderpriority") == "5-LOW", F.concat(dash, F.lit("x")))
             .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yyyy/MM/dd"))
             .otherwise(dash))


@query("parse_dates", f"""
SELECT o_orderkey, strftime(TRY_CAST(replace(CASE WHEN t = 'NA' THEN NULL ELSE t END, '/', '-') AS DATE), '%Y-%m-%d')
       AS order_date
FROM (SELECT o_orderkey, {_DATE_TEXT_SQL} AS t FROM orders)
""")
def q_parse_dates(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", _date_text().alias("order_date"))
    o = rc.parse_dates(rc.null_tokens(o, ["order_date"]), ["order_date"], as_date=True)
    return o.select("o_orderkey", iso("order_date").alias("order_date"))


# -------------------------------------------------------------------- P9 --
def _tokens_sql(col: str) -> str:
    return " OR ".join(f"contains({col}, '{t}')" for t in codes.NAME_EXCLUSION)


@query("name_exclude", f"""
SELECT conv_id, turn FROM (
  SELECT conv_id, turn, role, text,
         replace(lower(role), '.', '') AS n1, replace(lower(text), '.', '') AS n2
  FROM conversations)
WHERE role IS NOT NULL AND text IS NOT NULL
  AND NOT ({_tokens_sql('n1')}) AND length(n1) <> 1 AND NOT regexp_matches(n1, '\\p{{Nd}}')
  AND NOT ({_tokens_sql('n2')}) AND length(n2) <> 1 AND NOT regexp_matches(n2, '\\p{{Nd}}')
""")
def q_name_exclude(spark, d):
    c = table(spark, d, "conversations")
    return rc.exclude_names(c, ["role", "text"]).select("conv_id", "turn")


@query("name_exclude_documents", f"""
SELECT doc_id FROM (
  SELECT doc_id, lang, text, replace(lower(lang), '.', '') AS n1, replace(lower(text), '.', '') AS n2
  FROM documents)
WHERE lang IS NOT NULL AND text IS NOT NULL
  AND NOT ({_tokens_sql('n1')}) AND length(n1) <> 1 AND NOT regexp_matches(n1, '\\p{{Nd}}')
  AND NOT ({_tokens_sql('n2')}) AND length(n2) <> 1 AND NOT regexp_matches(n2, '\\p{{Nd}}')
""")
def q_name_exclude_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return rc.exclude_names(docs, ["lang", "text"]).select("doc_id")


# ---------------------------------------------------------------- A1 / E1 --
@query("group_min_size", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL
                     GROUP BY l_orderkey HAVING count(*) > 1)
""")
def q_group_min_size(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return ag.groups_only(li, "l_orderkey")


# ---------------------------------------------------------------- R1 / R2 --
@query("split_stage", f"""
WITH d AS (
  SELECT l_orderkey, l_linestatus, l_returnflag, l_linenumber FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus, l_returnflag
                                 ORDER BY {_LI_TIE_DESC}) AS rn
    FROM (SELECT * REPLACE (CASE WHEN l_linenumber = 7 THEN 'U' ELSE l_linestatus END AS l_linestatus) FROM lineitem)) WHERE rn = 1),
e AS (SELECT l_orderkey, l_returnflag AS l_returnflag_entry, l_linenumber AS l_linenumber_entry
      FROM d WHERE l_linestatus = 'F'),
x AS (SELECT l_orderkey, l_returnflag AS l_returnflag_exit, l_linenumber AS l_linenumber_exit
      FROM d WHERE l_linestatus = 'O')
SELECT coalesce(e.l_orderkey, x.l_orderkey) AS l_orderkey, l_returnflag_entry, l_linenumber_entry,
       l_returnflag_exit, l_linenumber_exit
FROM e FULL OUTER JOIN x ON e.l_orderkey IS NOT DISTINCT FROM x.l_orderkey
""")
def q_split_stage(spark, d):
    li = table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") == 7, "U").otherwise(F.col("l_linestatus")).alias("l_linestatus"),
                                            "l_returnflag", *LI_ORDER)
    li = dedup.keep_last(li, ["l_orderkey", "l_linestatus", "l_returnflag"], LI_TIE)
    li = li.select("l_orderkey", "l_linestatus", "l_returnflag", "l_linenumber")
    return reshape.entry_exit_wide(li, "l_linestatus", "F", "O", "l_orderkey")


# -------------------------------------------------------------------- R3 --
_FLAG_TYPES = [(1, "flagA"), (2, "flagN"), (3, "flagR")]


@query("type_stage_wide", "SELECT l_orderkey, " + ", ".join(
    f"max(CASE WHEN l_linestatus = '{s}' AND l_returnflag = '{n[-1]}' THEN l_quantity END) AS {n}{sfx}"
    for s, sfx in (("F", "_entry"), ("O", "_exit")) for _, n in _FLAG_TYPES)
    + " FROM lineitem WHERE l_linestatus IN ('F', 'O') AND l_returnflag IN ('A', 'N', 'R') GROUP BY l_orderkey")
def q_type_stage_wide(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_quantity",
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
         .when(F.col("l_returnflag") == "R", 3).alias("rtype"))
    return reshape.type_stage_wide(li, "l_orderkey", "l_linestatus", "rtype", "l_quantity",
                                   "F", "O", _FLAG_TYPES, one_row=True)


# -------------------------------------------------------------------- A3 --
@query("max_per_key", f"""
SELECT l_orderkey, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice,
       max(l_discount) AS l_discount, arg_min(l_returnflag, {_LI_TIE_SQL}) AS l_returnflag,
       arg_min(l_linestatus, {_LI_TIE_SQL}) AS l_linestatus,
       strftime(arg_min(l_shipdate, {_LI_TIE_SQL}), '%Y-%m-%d') AS l_shipdate
FROM lineitem GROUP BY l_orderkey
""")
def q_max_per_key(spark, d):
    li = table(spark, d, "lineitem").select(
        *LI_ORDER, "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    li = li.withColumn("_o", F.struct(*LI_TIE))
    r = ag.max_per_key(li, "l_orderkey", ["l_quantity", "l_extendedprice", "l_discount"], ["_o"])
    return r.select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag",
                    "l_linestatus", iso("l_shipdate").alias("l_shipdate"))


# ------------------------------------------------------------- D5 - D7 -----
_STATS_SQL = """SELECT o_custkey, count(*) AS n, count({c}) AS cnt, min({c}) AS lo, max({c}) AS hi
FROM {src} WHERE o_custkey IS NOT NULL GROUP BY o_custkey"""
_UNCHANGED = "(s.n IS NULL OR s.n = 1 OR s.cnt = 0 OR (s.cnt = s.n AND s.lo = s.hi))"
_TIME_SQL = f"""CASE WHEN {_UNCHANGED} THEN {{c}} WHEN s.cnt = 1 THEN s.hi
  WHEN epoch_us(s.hi) - epoch_us(s.lo) < 31536000000000
    THEN date_trunc('day', s.lo + to_microseconds(CAST(floor((epoch_us(s.hi) - epoch_us(s.lo)) / 1000000) AS BIGINT) * 500000))
  ELSE NULL END"""
_FLAG_SQL = "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE NULL END"
_CODE_SQL = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END"


def _flag() -> Column:
    return F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)


def _code() -> Column:
    return F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(
        F.substring("o_orderpriority", 1, 1).cast("int"))


@query("conflict_time", f"""
WITH s AS ({_STATS_SQL.format(c='o_orderdate', src='orders')})
SELECT o.o_orderkey, o.o_custkey, strftime({_TIME_SQL.format(c='o.o_orderdate')}, '%Y-%m-%d') AS o_orderdate
FROM orders o LEFT JOIN s ON o.o_custkey = s.o_custkey
""")
def q_conflict_time(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    r = dedup.resolve_conflicts(o, "o_custkey", time_cols=["o_orderdate"])
    return r.withColumn("o_orderdate", iso("o_orderdate"))


@query("conflict_bool", f"""
WITH b AS (SELECT o_orderkey, o_custkey, {_FLAG_SQL} AS flag FROM orders),
s AS (SELECT o_custkey, max(flag) AS hi FROM b WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT b.o_orderkey, b.o_custkey, CASE WHEN b.o_custkey IS NULL THEN b.flag ELSE s.hi END AS flag
FROM b LEFT JOIN s ON b.o_custkey = s.o_custkey
""")
def q_conflict_bool(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", _flag().alias("flag"))
    return dedup.resolve_conflicts(o, "o_custkey", bool_cols=["flag"])


@query("conflict_code", f"""
WITH b AS (SELECT o_orderkey, o_custkey, {_CODE_SQL} AS code FROM orders),
s AS ({_STATS_SQL.format(c='code', src='b')})
SELECT b.o_orderkey, b.o_custkey,
       CASE WHEN {_UNCHANGED} THEN b.code WHEN s.cnt = 1 THEN s.hi ELSE NULL END AS code
FROM b LEFT JOIN s ON b.o_custkey = s.o_custkey
""")
def q_conflict_code(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", _code().alias("code"))
    return dedup.resolve_conflicts(o, "o_custkey", code_cols=["code"])


# ------------------------------------------------------------- D8 / D9 ----
@query("bad_date", f"""
WITH fe AS (SELECT o.o_custkey, min(l.l_shipdate) AS first_entry
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
            WHERE o.o_custkey IS NOT NULL GROUP BY o.o_custkey),
c AS (SELECT o.o_orderkey, o.o_custkey,
             CASE WHEN coalesce(o.o_orderdate > fe.first_entry, false)
                    OR coalesce(o.o_orderdate < TIMESTAMP '1900-01-01', false)
                  THEN NULL ELSE o.o_orderdate END AS dob
      FROM orders o LEFT JOIN fe ON o.o_custkey = fe.o_custkey),
s AS ({_STATS_SQL.format(c='dob', src='c')}),
r AS (SELECT c.o_orderkey, c.o_custkey, {_TIME_SQL.format(c='c.dob')} AS dob
      FROM c LEFT JOIN s ON c.o_custkey = s.o_custkey),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, dob ORDER BY o_orderkey DESC) AS rn FROM r)
SELECT o_custkey, o_orderkey, strftime(dob, '%Y-%m-%d') AS dob FROM k WHERE rn = 1
""")
def q_bad_date(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("dob"))
    li = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    enr = li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    first = ag.earliest_per_key(enr, "o_custkey", "l_shipdate")
    c = dedup.null_bad_dates(o, "o_custkey", "dob", first)
    r = dedup.reconcile_dates(c, "o_custkey", "dob", ["o_custkey", "dob"], ["o_orderkey"])
    return r.select("o_custkey", "o_orderkey", iso("dob").alias("dob"))


# ------------------------------------------------------------ J1 / J2 -----
def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_DEST_VALUES = ", ".join(f"({c}, {_sql_text(dsc)}, {_sql_text(g)}, {_sql_text(s)}, {str(sub == 'Yes').lower()})"
                         for c, dsc, g, s, sub in codes.DESTINATIONS)
_PROJ_VALUES = ", ".join(f"({c}, {_sql_text(n)})" for c, n in codes.PROJECT_TYPES)


@query("code_label", f"""
SELECT p.p_partkey, d.DestinationNumeric, d.DestinationDescription, d.DestinationGroup,
       d.DestinationSuccess, d.Subsidy
FROM part p LEFT JOIN (VALUES {_DEST_VALUES})
  AS d(DestinationNumeric, DestinationDescription, DestinationGroup, DestinationSuccess, Subsidy)
  ON p.p_size = d.DestinationNumeric
""")
def q_code_label(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size")
    return joins.merge_destination(p, "p_size")


@query("project_label", f"""
SELECT p.p_partkey, t.ProjectNumeric, t.ProjectType
FROM part p LEFT JOIN (VALUES {_PROJ_VALUES}) AS t(ProjectNumeric, ProjectType)
  ON p.p_size = t.ProjectNumeric
""")
def q_project_label(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").alias("ProjectType"))
    return joins.label_project_type(p)


# -------------------------------------------------------------------- E9 --
@query("wide_merge", f"""
WITH li AS (SELECT l_orderkey, max(l_quantity) AS l_quantity,
                   arg_min(l_returnflag, {_LI_TIE_SQL}) AS l_returnflag
            FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, c.c_custkey AS o_custkey, strftime(o.o_orderdate, '%Y-%m-%d') AS o_orderdate,
       li.l_quantity, li.l_returnflag, c.c_name, n.n_name
FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey
RIGHT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def q_wide_merge(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, d, "lineitem").select(*LI_ORDER, "l_returnflag")
    li = li.select("l_orderkey", "l_quantity", "l_returnflag", F.struct(*LI_TIE).alias("_o"))
    li = ag.max_per_key(li, "l_orderkey", ["l_quantity"], ["_o"])
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    m = joins.safe_join(o, li, "o_orderkey", "l_orderkey", "left")
    m = joins.safe_join(m, c, "o_custkey", "c_custkey", "right")
    m = joins.safe_join(m, n, "c_nationkey", "n_nationkey", "left")
    return m.select("o_orderkey", "o_custkey", iso("o_orderdate").alias("o_orderdate"),
                    "l_quantity", "l_returnflag", "c_name", "n_name")


# -------------------------------------------------------------------- G1 --
@query("co_occurrence_group", """
WITH m AS (SELECT DISTINCT l_suppkey AS i, l_orderkey AS g FROM lineitem
           WHERE l_suppkey IS NOT NULL AND l_orderkey IS NOT NULL)
SELECT a.i AS id_a, b.i AS id_b, count(*) AS n_shared
FROM m a JOIN m b ON a.g = b.g AND a.i < b.i GROUP BY a.i, b.i
""")
def q_co_occurrence_group(spark, d):
    li = table(spark, d, "lineitem")
    return graph.group_co_occurrence(li, "l_suppkey", "l_orderkey")


# -------------------------------------------------------------------- G2 --
_PAIRS_SQL = """SELECT DISTINCT least(a.user_id, b.user_id) AS id_a, greatest(a.user_id, b.user_id) AS id_b
  FROM e a JOIN e b ON abs(epoch_us(a.{t}) - epoch_us(b.{t})) <= 60000000 AND a.user_id <> b.user_id"""


@query("co_occurrence_time", f"""
WITH e AS (SELECT user_id, ts AS t1, date_trunc('hour', ts) AS t2 FROM events WHERE user_id IS NOT NULL),
p AS ({_PAIRS_SQL.format(t='t1')} UNION ALL {_PAIRS_SQL.format(t='t2')})
SELECT id_a, id_b, count(*) AS n_shared FROM p GROUP BY id_a, id_b
""")
def q_co_occurrence_time(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("ts").alias("t1"),
                                         F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("t2"))
    return graph.time_co_occurrence(e, "user_id", ["t1", "t2"], time_unit="s", time_delta=60)


# -------------------------------------------------------------------- G3 --
def _cc_sql(edges: str, nodes: str) -> str:
    """Recursive min-label propagation (independent of the star algorithm)."""
    return f"""ed AS (SELECT a, b FROM ({edges}) UNION SELECT b, a FROM ({edges})),
cc(node, comp) USING KEY (node) AS (
  SELECT node, node FROM ({nodes})
  UNION
  SELECT ed.b, min(cc.comp) FROM cc JOIN ed ON cc.node = ed.a GROUP BY ed.b
  HAVING min(cc.comp) < (SELECT c2.comp FROM recurring.cc c2 WHERE c2.node = ed.b))"""


@query("cluster_group", f"""
WITH RECURSIVE m AS (SELECT DISTINCT l_partkey AS i, l_orderkey AS g FROM lineitem
                     WHERE l_partkey IS NOT NULL AND l_orderkey IS NOT NULL),
{_cc_sql("SELECT m1.i AS a, m2.i AS b FROM m m1 JOIN m m2 ON m1.g = m2.g AND m1.i < m2.i",
         "SELECT DISTINCT l_partkey AS node FROM lineitem WHERE l_partkey IS NOT NULL")},
pos AS (SELECT l_partkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS p FROM lineitem),
first AS (SELECT cc.comp, min(pos.p) AS fp FROM cc JOIN pos ON cc.node = pos.l_partkey GROUP BY cc.comp),
lab AS (SELECT cc.node, dense_rank() OVER (ORDER BY first.fp) AS cluster FROM cc JOIN first USING (comp))
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, lab.cluster
FROM lineitem l LEFT JOIN lab ON l.l_partkey = lab.node
""")
def q_cluster_group(spark, d):
    li = table(spark, d, "lineitem").select(*LI_ORDER)
    r = graph.cluster(li, "l_partkey", LI_ORDER, group_var="l_orderkey")
    return r.select("l_orderkey", "l_linenumber", "l_partkey", "cluster")


@query("cluster_time", f"""
WITH RECURSIVE e AS (SELECT event_id, user_id, ts FROM events WHERE user_id IS NOT NULL),
{_cc_sql("SELECT x.user_id AS a, y.user_id AS b FROM e x JOIN e y ON abs(epoch_us(x.ts) - epoch_us(y.ts)) <= 2000000 AND x.user_id <> y.user_id",
         "SELECT DISTINCT user_id AS node FROM e")},
first AS (SELECT cc.comp, min(e.event_id) AS fp FROM cc JOIN e ON cc.node = e.user_id GROUP BY cc.comp),
lab AS (SELECT cc.node, dense_rank() OVER (ORDER BY first.fp) AS cluster FROM cc JOIN first USING (comp))
SELECT ev.event_id, ev.user_id, lab.cluster FROM events ev LEFT JOIN lab ON ev.user_id = lab.node
""")
def q_cluster_time(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    r = graph.cluster(e, "user_id", ["event_id"], time_var=["ts"], time_unit="s", time_delta=2)
    return r.select("event_id", "user_id", "cluster")


# -------------------------------------------------------------- L1 / L4 ---
def _feat_sql(col: str) -> str:
    return (f"CASE WHEN a.{col} IS NULL OR b.{col} IS NULL THEN NULL WHEN a.{col} = b.{col} THEN 1.0 "
            f"WHEN jaro_winkler_similarity(a.{col}, b.{col}) >= 0.85 THEN 1.0 ELSE 0.0 END")


def _pairs_sql(block: str, cols: list) -> str:
    feats = ", ".join(f"{_feat_sql(c)} AS {c}" for c in cols)
    nn = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in cols)
    ss = " + ".join(f"coalesce({c}, 0.0)" for c in cols)
    return f"""SELECT *, CASE WHEN ({nn}) > 0 THEN ({ss}) / ({nn}) END AS mean,
       coalesce(CASE WHEN ({nn}) > 0 THEN ({ss}) / ({nn}) END > 0.5, false) AS match
FROM (SELECT a.p_partkey AS id_a, b.p_partkey AS id_b, {feats}
      FROM part a JOIN part b ON a.{block} = b.{block} AND a.p_partkey < b.p_partkey)"""


_PASS1 = ("p_brand", {"p_name": "string", "p_type": "string"})
_PASS2 = ("p_name", {"p_brand": "string", "p_type": "string"})


@query("block_and_match", f"""
SELECT id_a, id_b, p_name, p_type, mean, match FROM ({_pairs_sql(_PASS1[0], list(_PASS1[1]))}) WHERE match
""")
def q_block_and_match(spark, d):
    p = table(spark, d, "part")
    return linkage.block_and_match(p, "p_partkey", _PASS1[0], _PASS1[1])


@query("link_records", f"""
WITH RECURSIVE f1 AS ({_pairs_sql(_PASS1[0], list(_PASS1[1]))}),
f2 AS ({_pairs_sql(_PASS2[0], list(_PASS2[1]))}),
{_cc_sql("SELECT id_a AS a, id_b AS b FROM f1 WHERE match UNION SELECT id_a, id_b FROM f2 WHERE match",
         "SELECT p_partkey AS node FROM part")},
st AS (SELECT comp, count(*) AS sz, min(node) AS lo FROM cc GROUP BY comp),
num AS (SELECT comp, dense_rank() OVER (ORDER BY CASE WHEN sz = 1 THEN 1 ELSE 0 END, lo) AS linkage_PID FROM st)
SELECT p.p_partkey, num.linkage_PID FROM part p JOIN cc ON p.p_partkey = cc.node JOIN num USING (comp)
""")
def q_link_records(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    passes = [{"block_variable": b, "match_variables": m} for b, m in (_PASS1, _PASS2)]
    return linkage.link_records(p, "p_partkey", ["p_partkey"], passes).select("p_partkey", "linkage_PID")


@query("match_dates", """
WITH d AS (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS dt FROM orders WHERE o_custkey IS NOT NULL),
p AS (SELECT a.o_orderkey AS id_a, b.o_orderkey AS id_b,
        CASE WHEN a.dt IS NULL OR b.dt IS NULL THEN NULL WHEN a.dt = b.dt THEN 1.0
             WHEN year(a.dt) = year(b.dt) AND month(a.dt) = day(b.dt) AND day(a.dt) = month(b.dt) THEN 0.5
             WHEN year(a.dt) = year(b.dt) AND day(a.dt) = day(b.dt)
                  AND (month(a.dt), month(b.dt)) IN ((6, 7), (7, 6), (9, 10), (10, 9)) THEN 0.5 ELSE 0.0 END AS dt,
        CASE WHEN a.o_orderpriority IS NULL OR b.o_orderpriority IS NULL THEN NULL
             WHEN jaro_winkler_similarity(a.o_orderpriority, b.o_orderpriority) >= 0.85 THEN 1.0 ELSE 0.0 END AS o_orderpriority
      FROM d a JOIN d b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey)
SELECT id_a, id_b, dt, o_orderpriority, (dt + o_orderpriority) / 2 AS mean, true AS match FROM p
WHERE (dt + o_orderpriority) / 2 > 0.2
""")
def q_match_dates(spark, d):
    """L1 with L3: one customer's orders on equal dates, swapped days and months, or mixed-up months."""
    o = table(spark, d, "orders").withColumn("dt", F.col("o_orderdate").cast("date"))
    return linkage.block_and_match(o, "o_orderkey", "o_custkey", {"dt": "date", "o_orderpriority": "string"}, match_threshold=0.2)


# -------------------------------------------------------------------- A6 --
@query("frequent_dates", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS value, count(*) AS n FROM orders
WHERE o_orderdate IS NOT NULL GROUP BY o_orderdate
HAVING year(o_orderdate) > 2018 OR year(o_orderdate) < 1900 OR count(*) >= 12
""")
def q_frequent_dates(spark, d):
    o = table(spark, d, "orders")
    return ag.frequent_values(o, "o_orderdate", 12).select(iso("value").alias("value"), "n")


# ----------------------------------------------------------- P11 - P15 ----
_EIGHT = ", ".join(str(11111111 * i) for i in range(1, 9))
_NINE = ", ".join(str(111111111 * i) for i in range(0, 10))


# eight equal digits for one order in 50, nine for another, no number for a third
@query("ssn_quality", f"""
WITH r AS (SELECT o_orderkey, o_orderdate,
                  CASE o_orderkey % 50 WHEN 0 THEN NULL WHEN 1 THEN 11111111 * (o_orderkey // 50 % 9)
                       WHEN 2 THEN 111111111 * (o_orderkey // 50 % 10)
                       ELSE CAST(floor(o_totalprice * 1000) AS BIGINT) END AS raw FROM orders),
s AS (SELECT o_orderkey, o_orderdate, CASE WHEN raw IN ({_EIGHT}) THEN NULL ELSE raw END AS ssn FROM r),
q AS (SELECT *, CASE WHEN ssn IS NULL THEN 3 WHEN ssn IN ({_NINE}) THEN 3
                     WHEN length(CAST(ssn AS VARCHAR)) < 9 THEN 2 ELSE 1 END AS ssn_dq FROM s)
SELECT o_orderkey, CAST(ssn AS VARCHAR) AS ssn_str, ssn_dq,
       CASE WHEN ssn_dq = 1 AND length(CAST(ssn AS VARCHAR)) = 9 THEN CAST(ssn AS VARCHAR) END AS ssn1,
       year(o_orderdate) AS dob_y, month(o_orderdate) AS dob_m, day(o_orderdate) AS dob_d
FROM q
""")
def q_ssn_quality(spark, d):
    key = F.col("o_orderkey")
    part = F.floor(key / 50).cast("bigint")
    o = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("dob"),
        F.when(key % 50 == 0, F.lit(None)).when(key % 50 == 1, part % 9 * 11111111).when(key % 50 == 2, part % 10 * 111111111)
         .otherwise(F.floor(F.col("o_totalprice") * 1000).cast("bigint")).cast("bigint").alias("ssn"))
    o = o.withColumn("ssn", rc.clean_ssn(F.col("ssn")))
    o = o.withColumn("ssn_dq", rc.ssn_repeated_digit(F.col("ssn"), rc.ssn_quality_pha(F.col("ssn"))))
    o = rc.date_parts(o, "dob")
    return o.select("o_orderkey", rc.stringify_ssn(F.col("ssn")).alias("ssn_str"), "ssn_dq",
                    rc.usable_ssn(F.col("ssn"), F.col("ssn_dq")).alias("ssn1"), "dob_y", "dob_m", "dob_d")


# --------------------------------------------------------------- W6 / G6 --
@query("pad_ids", """
SELECT o_orderkey, printf('ord1_%06d', row_number() OVER (ORDER BY o_orderkey)) AS pid1 FROM orders
""")
def q_pad_ids(spark, d):
    o = table(spark, d, "orders").select("o_orderkey")
    o = graph.dense_ids(o, ["o_orderkey"], out="_n")
    return o.select("o_orderkey", rc.seq_id("ord1_", F.col("_n")).alias("pid1"))


# -------------------------------------------------------------------- A7 --
@query("modal_value", """
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
SELECT c.user_id, c.event_type, c.n FROM c
JOIN (SELECT user_id, max(n) AS m FROM c GROUP BY user_id) t ON c.user_id = t.user_id
WHERE c.n = t.m
""")
def q_modal_value(spark, d):
    return ag.modal_value(table(spark, d, "events"), "user_id", "event_type", keep_ties=True)


# ------------------------------------------------ spells from orders -------
# person = customer, spell = order, entry = order date, exit = last ship date
# (open for status O/P), agency and project type from the priority.
_SPELLS_SQL = """sp AS (
  SELECT o.o_orderkey, o.o_custkey AS linkage_PID, CAST(o.o_orderdate AS DATE) AS entry,
         CASE WHEN o.o_orderstatus IN ('O', 'P') THEN NULL ELSE CAST(li.last_ship AS DATE) END AS exit,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'SHA' WHEN '2-HIGH' THEN 'KCHA' ELSE 'HMIS' END AS agency,
         CASE o.o_orderpriority WHEN '3-MEDIUM' THEN 'Emergency Shelter' WHEN '4-NOT SPECIFIED' THEN NULL
              WHEN '5-LOW' THEN 'Street Outreach' ELSE 'Transitional Housing' END AS hmis_proj_type
  FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) li
    ON o.o_orderkey = li.l_orderkey
  WHERE o.o_custkey IS NOT NULL)"""
_SHORT_SQL = "coalesce(hmis_proj_type IN (" + ", ".join(_sql_text(p) for p in codes.SHORT_STAY_PROJECTS) + "), false)"
_HEXIT_SQL = f"""CASE
  WHEN agency = 'HMIS' AND exit IS NULL AND NOT {_SHORT_SQL} AND n_exit IS NOT NULL THEN n_entry
  WHEN agency = 'HMIS' AND exit IS NULL AND NOT {_SHORT_SQL} AND n_exit IS NULL THEN DATE '2017-12-31'
  WHEN agency = 'HMIS' AND exit IS NULL AND {_SHORT_SQL} AND n_exit IS NOT NULL AND n_entry - entry >= 90 THEN entry + 90
  WHEN agency = 'HMIS' AND exit IS NULL AND {_SHORT_SQL} AND n_exit IS NOT NULL AND n_entry - entry < 90 THEN n_entry
  WHEN agency = 'HMIS' AND exit IS NULL AND {_SHORT_SQL} AND n_exit IS NULL THEN entry + 90
  ELSE exit END"""
_IMPUTED_SQL = f"""{_SPELLS_SQL},
nx AS (SELECT *, lead(entry) OVER w AS n_entry, lead(exit) OVER w AS n_exit FROM sp
       WINDOW w AS (PARTITION BY linkage_PID ORDER BY entry NULLS LAST, o_orderkey)),
im AS (SELECT o_orderkey, linkage_PID, entry, exit, agency, hmis_proj_type, {_HEXIT_SQL} AS h_exit FROM nx)"""


def _spells(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    last = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    s = o.join(last, o["o_orderkey"] == last["l_orderkey"], "left")
    pr = F.col("o_orderpriority")
    return s.select(
        "o_orderkey", F.col("o_custkey").alias("linkage_PID"), F.col("o_orderdate").cast("date").alias("entry"),
        F.when(F.col("o_orderstatus").isin("O", "P"), F.lit(None)).otherwise(
            F.col("last_ship").cast("date")).alias("exit"),
        F.when(pr == "1-URGENT", "SHA").when(pr == "2-HIGH", "KCHA").otherwise("HMIS").alias("agency"),
        F.when(pr == "3-MEDIUM", "Emergency Shelter").when(pr == "4-NOT SPECIFIED", F.lit(None))
         .when(pr == "5-LOW", "Street Outreach").otherwise("Transitional Housing").alias("hmis_proj_type"),
    ).filter(F.col("linkage_PID").isNotNull())


@query("impute_exit", f"""
WITH {_IMPUTED_SQL}
SELECT o_orderkey, linkage_PID, strftime(h_exit, '%Y-%m-%d') AS h_exit FROM im
""")
def q_impute_exit(spark, d):
    sp = _spells(spark, d)
    r = spells.impute_exit(sp, tiebreak=["o_orderkey"])
    return r.select("o_orderkey", "linkage_PID", iso("h_exit").alias("h_exit"))


def _union_len_sql(src: str, keys: str, out: str, tb: str = "o_orderkey") -> str:
    """Covered days by gaps and islands (independent of the running-max method)."""
    return f"""{out}_x AS (SELECT {keys}, s, e, {tb},
        max(e) OVER (PARTITION BY {keys} ORDER BY s, e, {tb}
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
      FROM {src} WHERE s IS NOT NULL AND e IS NOT NULL),
{out}_y AS (SELECT *, sum(CASE WHEN pm IS NULL OR s > pm THEN 1 ELSE 0 END)
        OVER (PARTITION BY {keys} ORDER BY s, e, {tb}) AS isl FROM {out}_x),
{out}_z AS (SELECT {keys}, isl, greatest(max(e) - min(s), 0) AS len FROM {out}_y GROUP BY {keys}, isl),
{out} AS (SELECT {keys}, CAST(sum(len) AS BIGINT) AS {out} FROM {out}_z GROUP BY {keys})"""


_SERVICE_SQL = f"""{_IMPUTED_SQL},
sv AS (SELECT *, h_exit - entry AS sd0, CASE WHEN h_exit - entry < 0 THEN exit ELSE entry END AS s,
              h_exit AS e FROM im),
{_union_len_sql("sv", "linkage_PID, agency", "h_agency_time")},
{_union_len_sql("sv", "linkage_PID", "h_tot_time")},
fin AS (SELECT sv.o_orderkey, sv.linkage_PID, sv.agency,
          CASE WHEN sd0 IS NULL OR sd0 < 0 THEN NULL ELSE entry END AS h_entry,
          CASE WHEN sd0 IS NULL OR sd0 < 0 THEN NULL ELSE h_exit END AS h_exit,
          CASE WHEN sd0 IS NULL OR sd0 < 0 THEN NULL ELSE CAST(h_exit - entry + 1 AS INTEGER) END AS h_servdays,
          coalesce(a.h_agency_time, 0) AS h_agency_time, coalesce(t.h_tot_time, 0) AS h_tot_time
        FROM sv LEFT JOIN h_agency_time a ON sv.linkage_PID = a.linkage_PID AND sv.agency = a.agency
        LEFT JOIN h_tot_time t ON sv.linkage_PID = t.linkage_PID)"""


@query("covered_days", f"""
WITH {_SERVICE_SQL}
SELECT o_orderkey, linkage_PID, strftime(h_entry, '%Y-%m-%d') AS h_entry, strftime(h_exit, '%Y-%m-%d') AS h_exit,
       h_servdays, h_agency_time, h_tot_time, CASE WHEN h_servdays IS NULL THEN 1 ELSE 0 END AS h_time_qual
FROM fin
""")
def q_covered_days(spark, d):
    sp = _spells(spark, d)
    r = spells.impute_exit(sp, tiebreak=["o_orderkey"])
    r = spells.service_days(r)
    return r.select("o_orderkey", "linkage_PID", iso("h_entry").alias("h_entry"), iso("h_exit").alias("h_exit"),
                    "h_servdays", "h_agency_time", "h_tot_time", "h_time_qual")


@query("transitions", f"""
WITH {_SERVICE_SQL},
tr AS (SELECT o_orderkey, agency, h_entry, h_exit,
         lead(agency) OVER w AS n_agency, lead(h_entry) OVER w AS n_entry, lead(h_exit) OVER w AS n_exit
       FROM fin WINDOW w AS (PARTITION BY linkage_PID ORDER BY h_entry NULLS LAST, h_exit NULLS LAST, o_orderkey))
SELECT o_orderkey, CASE WHEN n_agency IS NULL THEN agency ELSE agency || ' to ' || n_agency END AS h_agency_trans,
       CAST(n_entry - h_exit AS INTEGER) AS h_t2next_prog,
       (n_entry <= h_exit) AND (h_entry <= n_exit) AS h_overlap,
       (n_entry >= h_entry) AND (n_exit <= h_exit) AS h_within
FROM tr
""")
def q_transitions(spark, d):
    sp = _spells(spark, d)
    r = spells.impute_exit(sp, tiebreak=["o_orderkey"])
    r = spells.service_days(r)
    r = spells.transitions(r, tiebreak=["o_orderkey"])
    return r.select("o_orderkey", "h_agency_trans", "h_t2next_prog", "h_overlap", "h_within")


# ------------------------------------------------ household measures -------
# household = order, entry = order date, person = line; age from a birth
# date derived from the quantity; relationship code from the flags.
_HH_BASE_SQL = """hb AS (
  SELECT l.l_orderkey AS hh_id, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
         CAST(o.o_orderdate AS DATE) AS entry,
         CASE WHEN l.l_quantity > 45 THEN NULL
              ELSE CAST(o.o_orderdate AS DATE) - CAST(l.l_quantity * 1000 AS INTEGER) END AS h_dob,
         CASE WHEN l.l_returnflag = 'A' THEN 'Y' WHEN l.l_returnflag = 'R' THEN 'F'
              WHEN l.l_linestatus = 'F' THEN '2' ELSE 'D' END AS relcode,
         CASE WHEN l.l_discount >= 0.05 THEN 'Disabled' ELSE 'Not disabled' END AS disability
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def _if3(c: str, a: str, b: str) -> str:
    return f"CASE WHEN ({c}) IS NULL THEN NULL WHEN {c} THEN {a} ELSE {b} END"


_CHILD_SQL = _if3("a1 < 18 AND h_relcode = 'Y'", "'yes'", _if3(
    "a1 < 18 AND h_relcode = 'F'", "'yes'", _if3(
        "a1 < 18 AND h_relcode = '2'", "'yes'", _if3(
            "a1 IS NULL AND h_relcode = 'Y'", "'relcode'", _if3(
                "a1 >= 18 AND h_relcode = 'Y'", "'relcode'", "'no'")))))


def _any_sql(c: str) -> str:
    return (f"CASE WHEN sum(CASE WHEN {c} THEN 1 ELSE 0 END) OVER w > 0 THEN true "
            f"WHEN sum(CASE WHEN ({c}) IS NULL THEN 1 ELSE 0 END) OVER w > 0 THEN NULL ELSE false END")


def _rsum_sql(c: str) -> str:
    return (f"CASE WHEN sum(CASE WHEN ({c}) IS NULL THEN 1 ELSE 0 END) OVER w > 0 THEN NULL "
            f"ELSE CAST(sum(CAST({c} AS INTEGER)) OVER w AS BIGINT) END")


@query("household_mix", f"""
WITH {_HH_BASE_SQL},
ag AS (SELECT *, (entry - h_dob) / 365.25 AS a0,
              CASE WHEN relcode IN ('', '99', 'D', 'M', 'N') THEN NULL ELSE relcode END AS h_relcode FROM hb),
a1 AS (SELECT *, {_if3("a0 < 0 OR a0 > 120", "NULL", "a0")} AS a1 FROM ag),
ch AS (SELECT *, {_CHILD_SQL} AS h_child FROM a1),
a2 AS (SELECT *, {_if3("h_child <> 'no' AND a1 > 25", "NULL", "a1")} AS h_age FROM ch),
el AS (SELECT *, {_if3("h_child = 'no' AND h_age >= 62", "'yes'", _if3("h_child = 'no' AND h_age IS NULL", "NULL", "'no'"))} AS h_elder FROM a2),
hh AS (SELECT *, count(*) OVER w AS h_hh_ct, {_rsum_sql("h_child <> 'no'")} AS h_hh_kids,
              {_rsum_sql("h_child = 'no'")} AS h_hh_adults,
              {_any_sql("h_elder = 'yes'")} AS e_any, {_any_sql("disability = 'Disabled'")} AS d_any
       FROM el WINDOW w AS (PARTITION BY hh_id, entry)),
t1 AS (SELECT *, {_if3("e_any", "'Elderly household'", "NULL")} AS t0 FROM hh),
t2 AS (SELECT *, {_if3("t0 IS NULL AND d_any", "'Non-elderly disabled household'", "t0")} AS t1x FROM t1)
SELECT hh_id, l_linenumber, l_partkey, l_suppkey, h_age,
       strftime(CASE WHEN a1 IS NULL THEN NULL ELSE h_dob END, '%Y-%m-%d') AS h_dob, h_relcode, h_child, h_elder,
       h_hh_ct, h_hh_kids, h_hh_adults,
       coalesce(t1x, 'Non-elderly non-disabled household') AS h_hh_type1,
       {_if3("h_hh_kids > 0 AND h_hh_adults > 1", "'multi-adult household with children'",
             _if3("h_hh_kids > 0 AND h_hh_adults = 1", "'single parent household with children'",
                  _if3("h_hh_kids = 0 AND h_hh_adults > 0", "'household without children'", "NULL")))} AS h_hh_type2
FROM t2
""")
def q_household_mix(spark, d):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("entry"))
    b = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    b = b.select(
        F.col("l_orderkey").alias("hh_id"), "l_linenumber", "l_partkey", "l_suppkey", "entry",
        F.when(F.col("l_quantity") > 45, F.lit(None))
         .otherwise(F.date_sub("entry", (F.col("l_quantity") * 1000).cast("int"))).alias("h_dob"),
        F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "R", "F")
         .when(F.col("l_linestatus") == "F", "2").otherwise("D").alias("relcode"),
        F.when(F.col("l_discount") >= 0.05, "Disabled").otherwise("Not disabled").alias("disability"))
    r = spells.age_and_relcode(b)
    r = spells.child_elder_flags(r)
    r = spells.household_mix(r)
    return r.select("hh_id", "l_linenumber", "l_partkey", "l_suppkey", "h_age", iso("h_dob").alias("h_dob"),
                    "h_relcode", "h_child", "h_elder", "h_hh_ct", "h_hh_kids", "h_hh_adults",
                    "h_hh_type1", "h_hh_type2")


# ------------------------------------------------ E10 - E12 ---------------
# HMIS-like enrollments: orders + customer (household = order date).
# Housing-authority-like spells: lineitem + orders + supplier (household =
# order).  Links: customer c -> person c, supplier s -> person s.
_AGENCY_SQL = """hm_src AS (
  SELECT 'o' || o.o_orderkey AS row_key, o.o_custkey AS PersonalID, strftime(o.o_orderdate, '%Y%m%d') AS HouseholdID,
         substr(o.o_orderpriority, 1, 1) AS RelationshipToHoH, c.c_name AS LastName, c.c_mktsegment AS FirstName,
         CAST(NULL AS VARCHAR) AS MiddleName, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) - 1 AS Gender,
         CAST(o.o_orderdate AS DATE) - CAST(floor(c.c_acctbal * 10) AS INTEGER) AS DOB,
         CASE WHEN c.c_nationkey < 3 THEN 1 ELSE 0 END AS AmIndAKNative,
         CASE WHEN c.c_nationkey BETWEEN 3 AND 8 THEN 1 ELSE 0 END AS Asian,
         CASE WHEN c.c_nationkey BETWEEN 9 AND 14 THEN 1 ELSE 0 END AS BlackAfAmerican,
         CASE WHEN c.c_nationkey = 15 THEN 1 ELSE 0 END AS NativeHIOtherPacific,
         CASE WHEN c.c_nationkey >= 16 THEN 1 ELSE 0 END AS White,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS Ethnicity,
         CAST(o.o_orderdate AS DATE) AS EntryDate,
         CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_orderdate AS DATE) + 30 END AS ExitDate,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Emergency Shelter' WHEN '2-HIGH' THEN 'Street Outreach'
              WHEN '3-MEDIUM' THEN 'Transitional Housing' WHEN '4-NOT SPECIFIED' THEN NULL
              ELSE 'PH - Rapid Re-Housing' END AS ProjectType,
         o.o_orderpriority AS ProjectName
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
pha_src AS (
  SELECT 'l' || l.l_orderkey || '_' || l.l_linenumber || '_' || l.l_partkey || '_' || l.l_suppkey || '_'
           || CAST(l.l_quantity AS VARCHAR) || '_' || CAST(l.l_extendedprice AS VARCHAR) AS row_key,
         l.l_suppkey AS pid, CASE WHEN l.l_returnflag = 'R' THEN 'KCHA' ELSE 'SHA' END AS agency_new,
         l.l_orderkey AS hh_id_new, CASE WHEN l.l_linestatus = 'F' THEN 'Y' ELSE '2' END AS relcode,
         s.s_name AS lname_new, l.l_returnflag AS fname_new, CAST(NULL AS VARCHAR) AS mname_new,
         CASE WHEN l.l_tax < 0.03 THEN 'Female' WHEN l.l_tax < 0.06 THEN 'Male' END AS gender2,
         CAST(o.o_orderdate AS DATE) - CAST(l.l_quantity * 500 AS INTEGER) AS dob,
         CASE WHEN l.l_discount < 0.02 THEN 1 WHEN l.l_discount > 0.08 THEN NULL ELSE 0 END AS r_aian_new,
         CAST(NULL AS INTEGER) AS r_asian_new, CASE WHEN l.l_tax > 0.05 THEN 1 ELSE 0 END AS r_black_new,
         0 AS r_nhpi_new, CASE WHEN l.l_discount > 0.05 THEN NULL ELSE 0 END AS r_white_new,
         CASE WHEN l.l_quantity < 10 THEN 'White only' WHEN l.l_quantity < 20 THEN 'Asian only'
              WHEN l.l_quantity < 30 THEN 'Multiple race' END AS race_new,
         CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS r_hisp_new,
         CASE WHEN l.l_discount > 0.05 THEN 'Disabled' ELSE 'Not disabled' END AS disability2,
         CAST(l.l_shipdate AS DATE) AS startdate,
         CAST(l.l_shipdate AS DATE) + CAST(l.l_quantity AS INTEGER) AS enddate,
         l.l_linestatus AS major_prog, l.l_returnflag AS prog_type, CAST(l.l_linenumber AS VARCHAR) AS subsidy_type,
         CAST(NULL AS VARCHAR) AS vouch_type_final, l.l_returnflag AS operator_type, l.l_linestatus AS portfolio_final
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey),
links AS (SELECT 'HMIS0_' || c_custkey AS pid0, c_custkey AS linkage_PID FROM customer
          UNION ALL SELECT 'PHA0_' || s_suppkey, s_suppkey FROM supplier),
hm AS (SELECT row_key, 'HMIS0_' || coalesce(CAST(PersonalID AS VARCHAR), 'NA') AS pid0,
              'HMIS_' || coalesce(HouseholdID, 'NA') AS hh_id, RelationshipToHoH AS relcode,
              LastName AS lname, FirstName AS fname, MiddleName AS mname,
              CASE Gender WHEN 0 THEN 'Fem' WHEN 1 THEN 'Mal' WHEN 2 THEN 'MTF' WHEN 3 THEN 'FTM' WHEN 4 THEN 'GNC' END AS gender,
              DOB AS dob, AmIndAKNative AS r_aian, Asian AS r_asian, BlackAfAmerican AS r_black,
              NativeHIOtherPacific AS r_nhpi, White AS r_white, Ethnicity AS r_ethnicity,
              EntryDate AS entry, ExitDate AS exit, 'HMIS' AS agency, ProjectType AS hmis_proj_type,
              ProjectName AS hmis_proj_name FROM hm_src),
ph AS (SELECT row_key, 'PHA0_' || coalesce(CAST(pid AS VARCHAR), 'NA') AS pid0,
              coalesce(agency_new, 'NA') || '_' || coalesce(CAST(hh_id_new AS VARCHAR), 'NA') AS hh_id,
              relcode, lname_new AS lname, fname_new AS fname, mname_new AS mname,
              CASE gender2 WHEN 'Female' THEN 'Fem' WHEN 'Male' THEN 'Mal' END AS gender, dob,
              CAST((r_aian_new = 1) OR (race_new = 'AIAN only') AS INTEGER) AS r_aian,
              CAST((r_asian_new = 1) OR (race_new = 'Asian only') AS INTEGER) AS r_asian,
              CAST((r_black_new = 1) OR (race_new = 'Black only') AS INTEGER) AS r_black,
              CAST((r_nhpi_new = 1) OR (race_new = 'NHPI only') AS INTEGER) AS r_nhpi,
              CAST((r_white_new = 1) OR (race_new = 'White only') AS INTEGER) AS r_white,
              CAST(race_new = 'Multiple race' AS INTEGER) AS r_multi, r_hisp_new AS r_ethnicity,
              disability2 AS disability, startdate AS entry, enddate AS exit, agency_new AS agency,
              major_prog AS ha_maj_prog, prog_type AS ha_prog_type, subsidy_type AS ha_sub_type,
              vouch_type_final AS ha_vouch_type, operator_type AS ha_op_type, portfolio_final AS ha_portfolio
       FROM pha_src),
merged AS (
  SELECT u.*, links.linkage_PID,
         CASE WHEN u.agency IN ('KCHA', 'SHA') THEN u.agency || ',' || coalesce(u.ha_sub_type, 'NA') || ','
              || coalesce(u.ha_vouch_type, 'NA') || ',' || coalesce(u.ha_op_type, 'NA') || ','
              || coalesce(u.ha_portfolio, 'NA') END AS ha_prog_cat,
         CASE WHEN u.agency = 'HMIS' THEN u.agency || ',' || coalesce(u.hmis_proj_type, 'NA') || ','
              || coalesce(u.hmis_proj_name, 'NA') || ',' END AS hmis_prog_cat
  FROM (SELECT * FROM hm UNION ALL BY NAME SELECT * FROM ph) u LEFT JOIN links ON u.pid0 = links.pid0)"""


def _agency_inputs(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    li, s = table(spark, d, "lineitem"), table(spark, d, "supplier")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"])
    pr, entry = F.col("o_orderpriority"), F.col("o_orderdate").cast("date")
    nat = F.col("c_nationkey")
    hm = oc.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("row_key"),
        F.col("o_custkey").alias("PersonalID"), F.date_format("o_orderdate", "yyyyMMdd").alias("HouseholdID"),
        F.substring(pr, 1, 1).alias("RelationshipToHoH"), F.col("c_name").alias("LastName"),
        F.col("c_mktsegment").alias("FirstName"), F.lit(None).cast("string").alias("MiddleName"),
        (F.substring(pr, 1, 1).cast("int") - 1).alias("Gender"),
        F.date_sub(entry, F.floor(F.col("c_acctbal") * 10).cast("int")).alias("DOB"),
        F.when(nat < 3, 1).otherwise(0).alias("AmIndAKNative"),
        F.when(nat.between(3, 8), 1).otherwise(0).alias("Asian"),
        F.when(nat.between(9, 14), 1).otherwise(0).alias("BlackAfAmerican"),
        F.when(nat == 15, 1).otherwise(0).alias("NativeHIOtherPacific"),
        F.when(nat >= 16, 1).otherwise(0).alias("White"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("Ethnicity"),
        entry.alias("EntryDate"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(entry, 30)).alias("ExitDate"),
        F.when(pr == "1-URGENT", "Emergency Shelter").when(pr == "2-HIGH", "Street Outreach")
         .when(pr == "3-MEDIUM", "Transitional Housing").when(pr == "4-NOT SPECIFIED", F.lit(None))
         .otherwise("PH - Rapid Re-Housing").alias("ProjectType"),
        pr.alias("ProjectName"))
    lo = li.join(o.select("o_orderkey", "o_orderdate"), li["l_orderkey"] == o["o_orderkey"]) \
           .join(s.select("s_suppkey", "s_name"), li["l_suppkey"] == s["s_suppkey"])
    rf, ls, tax, disc, qty = (F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_tax"),
                              F.col("l_discount"), F.col("l_quantity"))
    ship = F.col("l_shipdate").cast("date")
    ph = lo.select(
        F.concat_ws("_", *[F.col(c).cast("string") for c in LI_ORDER]).alias("_rk"),
        F.col("l_suppkey").alias("pid"), F.when(rf == "R", "KCHA").otherwise("SHA").alias("agency_new"),
        F.col("l_orderkey").alias("hh_id_new"), F.when(ls == "F", "Y").otherwise("2").alias("relcode"),
        F.col("s_name").alias("lname_new"), rf.alias("fname_new"), F.lit(None).cast("string").alias("mname_new"),
        F.when(tax < 0.03, "Female").when(tax < 0.06, "Male").alias("gender2"),
        F.date_sub(F.col("o_orderdate").cast("date"), (qty * 500).cast("int")).alias("dob"),
        F.when(disc < 0.02, 1).when(disc > 0.08, F.lit(None)).otherwise(0).alias("r_aian_new"),
        F.lit(None).cast("int").alias("r_asian_new"), F.when(tax > 0.05, 1).otherwise(0).alias("r_black_new"),
        F.lit(0).alias("r_nhpi_new"), F.when(disc > 0.05, F.lit(None)).otherwise(0).alias("r_white_new"),
        F.when(qty < 10, "White only").when(qty < 20, "Asian only").when(qty < 30, "Multiple race")
         .alias("race_new"),
        F.when(ls == "O", 1).otherwise(0).alias("r_hisp_new"),
        F.when(disc > 0.05, "Disabled").otherwise("Not disabled").alias("disability2"),
        ship.alias("startdate"), F.date_add(ship, qty.cast("int")).alias("enddate"),
        ls.alias("major_prog"), rf.alias("prog_type"), F.col("l_linenumber").cast("string").alias("subsidy_type"),
        F.lit(None).cast("string").alias("vouch_type_final"), rf.alias("operator_type"),
        ls.alias("portfolio_final"))
    ph = ph.withColumn("row_key", F.concat(F.lit("l"), F.col("_rk"))).drop("_rk")
    links = c.select(F.concat(F.lit("HMIS0_"), F.col("c_custkey").cast("string")).alias("pid0"),
                     F.col("c_custkey").alias("linkage_PID")).unionByName(
        s.select(F.concat(F.lit("PHA0_"), F.col("s_suppkey").cast("string")).alias("pid0"),
                 F.col("s_suppkey").alias("linkage_PID")))
    return hm, ph, links


def _merged(spark, d, columns=None):
    hm, ph, links = _agency_inputs(spark, d)
    return agencies.merge_agencies(hm, ph, links, keep=["row_key"], columns=columns)


_MERGED_COLS = ["row_key", "pid0", "hh_id", "relcode", "gender", "r_aian", "r_asian", "r_black", "r_nhpi",
                "r_white", "r_multi", "r_ethnicity", "disability", "agency", "hmis_proj_type",
                "linkage_PID", "ha_prog_cat", "hmis_prog_cat"]


@query("agency_union", f"""
WITH {_AGENCY_SQL}
SELECT {", ".join(_MERGED_COLS)}, strftime(dob, '%Y-%m-%d') AS dob, strftime(entry, '%Y-%m-%d') AS entry,
       strftime(exit, '%Y-%m-%d') AS exit FROM merged
""")
def q_agency_union(spark, d):
    m = _merged(spark, d)
    return m.select(*_MERGED_COLS, iso("dob").alias("dob"), iso("entry").alias("entry"), iso("exit").alias("exit"))


@query("household_clusters", f"""
WITH RECURSIVE {_AGENCY_SQL},
mm AS (SELECT DISTINCT linkage_PID AS i, hh_id AS g FROM merged WHERE linkage_PID IS NOT NULL AND hh_id IS NOT NULL),
{_cc_sql("SELECT m1.i AS a, m2.i AS b FROM mm m1 JOIN mm m2 ON m1.g = m2.g AND m1.i < m2.i",
         "SELECT DISTINCT i AS node FROM mm")},
sz AS (SELECT comp, count(*) AS n FROM cc GROUP BY comp),
num AS (SELECT comp, n, dense_rank() OVER (ORDER BY comp) AS h FROM sz)
SELECT merged.row_key, merged.pid0, merged.linkage_PID, CAST(num.h AS INTEGER) AS h_cluster,
       CAST(num.n AS INTEGER) AS h_cluster_ct
FROM merged LEFT JOIN cc ON merged.linkage_PID = cc.node LEFT JOIN num ON cc.comp = num.comp
""")
def q_household_clusters(spark, d):
    r = agencies.household_clusters(_merged(spark, d), columns=["row_key", "pid0"])
    return r.select("row_key", "pid0", "linkage_PID", "h_cluster", "h_cluster_ct")


_PHA_IN = "coalesce(agency IN (" + ", ".join(_sql_text(a) for a in codes.PHA_AGENCIES) + "), false)"
_SPELL_OUT = ["row_key", "linkage_PID", "agency", "h_age", "h_relcode", "h_child", "h_elder", "h_hh_ct",
              "h_hh_kids", "h_hh_adults", "h_hh_type1", "h_hh_type2", "h_servdays", "h_agency_time",
              "h_tot_time", "h_time_qual", "h_agency_trans", "h_t2next_prog", "h_overlap", "h_within"]


@query("person_spells", f"""
WITH {_AGENCY_SQL},
dm AS (SELECT linkage_PID, agency, dob AS h_dob FROM merged),
pc AS (SELECT linkage_PID, h_dob, count(*) AS n FROM dm WHERE {_PHA_IN} GROUP BY linkage_PID, h_dob),
pb AS (SELECT linkage_PID, h_dob FROM (SELECT *, row_number() OVER (PARTITION BY linkage_PID
         ORDER BY n DESC, h_dob ASC NULLS LAST) AS rn FROM pc) WHERE rn = 1),
hc AS (SELECT linkage_PID, h_dob, count(*) AS n FROM dm
       WHERE NOT EXISTS (SELECT 1 FROM pb WHERE pb.linkage_PID IS NOT DISTINCT FROM dm.linkage_PID)
       GROUP BY linkage_PID, h_dob),
hb AS (SELECT linkage_PID, h_dob FROM (SELECT *, row_number() OVER (PARTITION BY linkage_PID
         ORDER BY n DESC, h_dob ASC NULLS LAST) AS rn FROM hc) WHERE rn = 1),
rd AS (SELECT * FROM pb UNION ALL SELECT * FROM hb),
base AS (SELECT m.*, rd.h_dob AS h_dob0 FROM merged m LEFT JOIN rd ON m.linkage_PID = rd.linkage_PID
         WHERE m.linkage_PID IS NOT NULL AND m.entry >= DATE '1996-01-01'),
ag AS (SELECT *, (entry - h_dob0) / 365.25 AS a0,
              CASE WHEN relcode IN ('', '99', 'D', 'M', 'N') THEN NULL ELSE relcode END AS h_relcode FROM base),
a1 AS (SELECT *, {_if3("a0 < 0 OR a0 > 120", "NULL", "a0")} AS a1 FROM ag),
ch AS (SELECT *, {_CHILD_SQL} AS h_child FROM a1),
a2 AS (SELECT *, {_if3("h_child <> 'no' AND a1 > 25", "NULL", "a1")} AS h_age,
              CASE WHEN a1 IS NULL THEN NULL ELSE h_dob0 END AS h_dob FROM ch),
el AS (SELECT *, {_if3("h_child = 'no' AND h_age >= 62", "'yes'", _if3("h_child = 'no' AND h_age IS NULL", "NULL", "'no'"))} AS h_elder FROM a2),
hh AS (SELECT *, count(*) OVER w AS h_hh_ct, {_rsum_sql("h_child <> 'no'")} AS h_hh_kids,
              {_rsum_sql("h_child = 'no'")} AS h_hh_adults,
              {_any_sql("h_elder = 'yes'")} AS e_any, {_any_sql("disability = 'Disabled'")} AS d_any
       FROM el WINDOW w AS (PARTITION BY hh_id, entry)),
t1 AS (SELECT *, {_if3("e_any", "'Elderly household'", "NULL")} AS t0 FROM hh),
t2 AS (SELECT *, coalesce({_if3("t0 IS NULL AND d_any", "'Non-elderly disabled household'", "t0")},
                          'Non-elderly non-disabled household') AS h_hh_type1,
              {_if3("h_hh_kids > 0 AND h_hh_adults > 1", "'multi-adult household with children'",
                    _if3("h_hh_kids > 0 AND h_hh_adults = 1", "'single parent household with children'",
                         _if3("h_hh_kids = 0 AND h_hh_adults > 0", "'household without children'", "NULL")))} AS h_hh_type2
       FROM t1),
nx AS (SELECT *, lead(entry) OVER w AS n_entry, lead(exit) OVER w AS n_exit FROM t2
       WINDOW w AS (PARTITION BY linkage_PID ORDER BY entry NULLS LAST, row_key)),
im AS (SELECT *, {_HEXIT_SQL} AS hx FROM nx),
sv AS (SELECT *, hx - entry AS sd0, CASE WHEN hx - entry < 0 THEN exit ELSE entry END AS s, hx AS e FROM im),
{_union_len_sql("sv", "linkage_PID, agency", "h_agency_time", "row_key")},
{_union_len_sql("sv", "linkage_PID", "h_tot_time", "row_key")},
fin AS (SELECT sv.*, CASE WHEN sd0 IS NULL OR sd0 < 0 THEN NULL ELSE entry END AS h_entry,
          CASE WHEN sd0 IS NULL OR sd0 < 0 THEN NULL ELSE hx END AS h_exit,
          CASE WHEN sd0 IS NULL OR sd0 < 0 THEN NULL ELSE CAST(hx - entry + 1 AS INTEGER) END AS h_servdays,
          coalesce(a.h_agency_time, 0) AS h_agency_time, coalesce(t.h_tot_time, 0) AS h_tot_time
        FROM sv LEFT JOIN h_agency_time a ON sv.linkage_PID = a.linkage_PID AND sv.agency = a.agency
        LEFT JOIN h_tot_time t ON sv.linkage_PID = t.linkage_PID),
tr AS (SELECT *, CASE WHEN h_servdays IS NULL THEN 1 ELSE 0 END AS h_time_qual,
         lead(agency) OVER w AS n_agency, lead(h_entry) OVER w AS ne, lead(h_exit) OVER w AS nxx
       FROM fin WINDOW w AS (PARTITION BY linkage_PID ORDER BY h_entry NULLS LAST, h_exit NULLS LAST, row_key))
SELECT row_key, linkage_PID, agency, h_age, h_relcode, h_child, h_elder, h_hh_ct, h_hh_kids, h_hh_adults,
       h_hh_type1, h_hh_type2, h_servdays, h_agency_time, h_tot_time, h_time_qual,
       CASE WHEN n_agency IS NULL THEN agency ELSE agency || ' to ' || n_agency END AS h_agency_trans,
       CAST(ne - h_exit AS INTEGER) AS h_t2next_prog, (ne <= h_exit) AND (h_entry <= nxx) AS h_overlap,
       (ne >= h_entry) AND (nxx <= h_exit) AS h_within,
       strftime(h_dob, '%Y-%m-%d') AS h_dob, strftime(h_entry, '%Y-%m-%d') AS h_entry,
       strftime(h_exit, '%Y-%m-%d') AS h_exit
FROM tr
""")
def q_person_spells(spark, d):
    r = agencies.person_spell_frame(_merged(spark, d, ["row_key", *agencies.SPELL_COLUMNS]), min_entry="1996-01-01",
                                    tiebreak=["row_key"], columns=[])
    return r.select(*_SPELL_OUT, iso("h_dob").alias("h_dob"), iso("h_entry").alias("h_entry"),
                    iso("h_exit").alias("h_exit"))


# -------------------------------------------------------------------- L5 --
# housing-authority identities: orders of status F; HMIS identities: the
# other orders.  One identity per customer and order attributes.
_PRE_SSN_SQL = "CAST(floor(o_totalprice * 1000) AS BIGINT)"


_PRE_LNAME_SQL = "CASE WHEN o_custkey % 40 = 0 THEN 'Name Refused' ELSE o_orderpriority END"
_PRE_FNAME_SQL = "CASE WHEN o_custkey % 40 = 1 THEN 'anonymous' ELSE lower(o_orderstatus) END"


@query("prelink", f"""
WITH pa AS (SELECT DISTINCT 'PHA0_' || o_custkey AS pid0, {_PRE_SSN_SQL} AS ssn, {_PRE_LNAME_SQL} AS lname,
                   {_PRE_FNAME_SQL} AS fname, CAST(NULL AS VARCHAR) AS mname, CAST(NULL AS VARCHAR) AS suf,
                   CAST(o_orderdate AS DATE) AS dob,
                   CASE o_orderpriority WHEN '1-URGENT' THEN 'Female' WHEN '2-HIGH' THEN 'Male' END AS gen
            FROM orders WHERE o_orderstatus = 'F'),
ha AS (SELECT DISTINCT 'HMIS0_' || o_custkey AS pid0, {_PRE_SSN_SQL} AS ssn,
              CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS ssn_dq, {_PRE_LNAME_SQL} AS lname,
              {_PRE_FNAME_SQL} AS fname, CAST(NULL AS VARCHAR) AS mname, CAST(NULL AS VARCHAR) AS suf,
              CAST(o_orderdate AS DATE) AS dob, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS gen
       FROM orders WHERE o_orderstatus <> 'F'),
pbad AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'F' AND o_orderdate IS NOT NULL
         GROUP BY 1 HAVING year(d) > 2018 OR year(d) < 1900 OR count(*) >= 4),
hbad AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate IS NOT NULL
         GROUP BY 1 HAVING year(d) > 2018 OR year(d) < 1900 OR count(*) >= 7),
p2 AS (SELECT pid0, ssn, lname, fname, mname, suf, dob,
              CASE gen WHEN 'Female' THEN 1 WHEN 'Male' THEN 0 END AS gen,
              CASE WHEN ssn IS NULL THEN 3 WHEN length(CAST(ssn AS VARCHAR)) < 9 THEN 2 ELSE 1 END AS ssn_dq,
              CASE WHEN dob IN (SELECT d FROM pbad) THEN 2 ELSE 1 END AS dob_dq,
              0 AS src, row_number() OVER (ORDER BY pid0, ssn, lname, fname, dob, gen) AS seq FROM pa),
h2 AS (SELECT pid0, ssn, lname, fname, mname, suf, dob, gen,
              CASE WHEN ssn_dq > 2 THEN 3 ELSE ssn_dq END AS ssn_dq,
              CASE WHEN dob IN (SELECT d FROM hbad) THEN 2 ELSE 1 END AS dob_dq,
              1 AS src, row_number() OVER (ORDER BY pid0, ssn, ssn_dq, lname, fname, dob, gen) AS seq FROM ha),
u AS (SELECT *, printf('pha1_%06d', seq) AS pid1 FROM p2
      UNION ALL BY NAME SELECT *, printf('hmis1_%06d', seq) AS pid1 FROM h2),
q AS (SELECT * REPLACE (CASE WHEN ssn IS NULL OR ssn IN ({_NINE}) THEN 3 ELSE ssn_dq END AS ssn_dq),
             printf('pid2_%06d', row_number() OVER (ORDER BY src, seq)) AS pid2 FROM u)
SELECT pid0, CAST(ssn AS VARCHAR) AS ssn, upper(lname) AS lname, upper(fname) AS fname, mname, suf,
       strftime(dob, '%Y-%m-%d') AS dob, CAST(gen AS INTEGER) AS gen, ssn_dq, dob_dq, pid1, pid2,
       year(dob) AS dob_y, month(dob) AS dob_m, day(dob) AS dob_d,
       CASE WHEN ssn_dq = 1 AND length(CAST(ssn AS VARCHAR)) = 9 THEN ssn END AS ssn1,
       strftime(CASE WHEN dob_dq = 1 THEN dob END, '%Y-%m-%d') AS dob1,
       year(CASE WHEN dob_dq = 1 THEN dob END) AS dob1_y, month(CASE WHEN dob_dq = 1 THEN dob END) AS dob1_m,
       day(CASE WHEN dob_dq = 1 THEN dob END) AS dob1_d
FROM q
WHERE NOT coalesce(contains(upper(lname), 'REFUSED'), false) AND NOT coalesce(contains(upper(fname), 'REFUSED'), false)
  AND NOT coalesce(contains(upper(lname), 'ANONYMOUS'), false) AND NOT coalesce(contains(upper(fname), 'ANONYMOUS'), false)
""")
def q_prelink(spark, d):
    from . import prelink
    o = table(spark, d, "orders")
    base = o.select(F.col("o_custkey"), F.floor(F.col("o_totalprice") * 1000).cast("bigint").alias("ssn"),
                    F.when(F.col("o_custkey") % 40 == 0, "Name Refused").otherwise(F.col("o_orderpriority")).alias("lname"),
                    F.when(F.col("o_custkey") % 40 == 1, "anonymous").otherwise(F.lower("o_orderstatus")).alias("fname"),
                    F.lit(None).cast("string").alias("mname"), F.lit(None).cast("string").alias("suf"),
                    F.col("o_orderdate").cast("date").alias("dob"), "o_orderstatus", "o_orderpriority")
    pr = F.col("o_orderpriority")
    pha = base.filter(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("PHA0_"), F.col("o_custkey").cast("string")).alias("pid0"), "ssn", "lname", "fname",
        "mname", "suf", "dob", F.when(pr == "1-URGENT", "Female").when(pr == "2-HIGH", "Male").alias("gen"))
    hm = base.filter(F.col("o_orderstatus") != "F").select(
        F.concat(F.lit("HMIS0_"), F.col("o_custkey").cast("string")).alias("pid0"), "ssn",
        F.substring(pr, 1, 1).cast("int").alias("ssn_dq"), "lname", "fname", "mname", "suf", "dob",
        F.substring(pr, 1, 1).cast("int").alias("gen"))
    ident = {c: c for c in ["pid0", "ssn", "lname", "fname", "mname", "suf", "dob", "gen"]}
    pv = prelink.pha_variants(pha, ident, min_freq=4,
                              order=["pid0", "ssn", "lname", "fname", "dob", "gen"])
    hv = prelink.hmis_variants(hm, {**ident, "ssn_dq": "ssn_dq"}, min_freq=7,
                               order=["pid0", "ssn", "ssn_dq", "lname", "fname", "dob", "gen"])
    t = prelink.prelink_table(pv, hv)
    return t.select("pid0", F.col("ssn").cast("string").alias("ssn"), "lname", "fname", "mname", "suf",
                    iso("dob").alias("dob"), F.col("gen").cast("int").alias("gen"), "ssn_dq", "dob_dq",
                    "pid1", "pid2", "dob_y", "dob_m", "dob_d", "ssn1", iso("dob1").alias("dob1"),
                    "dob1_y", "dob1_m", "dob1_d")


# ------------------------------------------------------------ D4 / E3 -----
# client rows = orders; person = customer; keys = (customer, priority).
_CLIENT_BASE_SQL = f"""b AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate, {_FLAG_SQL} AS flag,
                  {_CODE_SQL} AS code FROM orders),
d1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority, o_orderdate,
         flag, code ORDER BY o_orderkey DESC) AS rn FROM b) WHERE rn = 1)"""


@query("client_resolve", f"""
WITH {_CLIENT_BASE_SQL},
st AS ({_STATS_SQL.format(c='o_orderdate', src='d1')}),
sc AS ({_STATS_SQL.format(c='code', src='d1')}),
sf AS (SELECT o_custkey, max(flag) AS hi FROM d1 WHERE o_custkey IS NOT NULL GROUP BY o_custkey),
r AS (SELECT d1.o_orderkey, d1.o_custkey, d1.o_orderpriority,
             {_TIME_SQL.format(c='d1.o_orderdate')} AS o_orderdate,
             CASE WHEN d1.o_custkey IS NULL THEN d1.flag ELSE sf.hi END AS flag,
             (SELECT CASE WHEN {_UNCHANGED} THEN d1.code WHEN s.cnt = 1 THEN s.hi ELSE NULL END
              FROM (SELECT 1) z LEFT JOIN sc s ON s.o_custkey = d1.o_custkey) AS code
      FROM d1 LEFT JOIN st s ON d1.o_custkey = s.o_custkey LEFT JOIN sf ON d1.o_custkey = sf.o_custkey),
k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) AS rn FROM r)
SELECT o_custkey, o_orderpriority, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, flag, code
FROM k WHERE rn = 1
""")
def q_client_resolve(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate",
                                         _flag().alias("flag"), _code().alias("code"))
    keys = ["o_custkey", "o_orderpriority"]
    o = dedup.keep_last(o, keys + ["o_orderdate", "flag", "code"], ["o_orderkey"])
    o = dedup.resolve_conflicts(o, "o_custkey", time_cols=["o_orderdate"], bool_cols=["flag"],
                                code_cols=["code"])
    o = dedup.keep_last(o, keys, ["o_orderkey"])
    return o.select(*keys, "o_orderkey", iso("o_orderdate").alias("o_orderdate"), "flag", "code")


# ------------------------------------------------------- R3 compat -------
def _ns_full(left: str, right: str, keys: list, lcols: list, rcols: list) -> str:
    on = " AND ".join(f"{left}.{k} IS NOT DISTINCT FROM {right}.{k}" for k in keys)
    sel = ", ".join([f"coalesce({left}.{k}, {right}.{k}) AS {k}" for k in keys]
                    + [f"{left}.{c}" for c in lcols] + [f"{right}.{c}" for c in rcols])
    return f"SELECT {sel} FROM {left} FULL OUTER JOIN {right} ON {on}"


_FLAG_SQL = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END"


def _compat_sql(distinct: bool = False, types=_FLAG_TYPES, kind: str = _FLAG_SQL, response: str = "l_quantity") -> str:
    names = [n for _, n in types]
    codes_ = {n: t for t, n in types}
    parts = [f"base AS (SELECT {'DISTINCT' if distinct else ''} l_orderkey AS id, l_linestatus AS st, {kind} AS ty, "
             f"{f'CAST({response} AS BIGINT)' if distinct else response} AS rs FROM lineitem)",
             "e AS (SELECT id, ty AS ty_e, rs AS rs_e FROM base WHERE st = 'F')",
             "x AS (SELECT id, ty AS ty_x, rs AS rs_x FROM base WHERE st = 'O')",
             f"w AS ({_ns_full('e', 'x', ['id'], ['ty_e', 'rs_e'], ['ty_x', 'rs_x'])})"]
    k1 = ["id", "ty_x", "rs_x"]
    for n in names:
        parts.append(f"p_{n} AS (SELECT id, ty_x, rs_x, rs_e AS rs_e_{n} FROM w WHERE ty_e = {codes_[n]})")
    acc, acc_cols = f"p_{names[0]}", [f"rs_e_{names[0]}"]
    for i, n in enumerate(names[1:], 1):
        parts.append(f"s1_{i} AS ({_ns_full(acc, f'p_{n}', k1, acc_cols, [f'rs_e_{n}'])})")
        acc, acc_cols = f"s1_{i}", acc_cols + [f"rs_e_{n}"]
    step1 = acc
    k2 = ["id"] + [f"rs_e_{n}" for n in names]
    for n in names:
        parts.append(f"q_{n} AS (SELECT {', '.join(k2)}, rs_x AS rs_x_{n} FROM {step1} WHERE ty_x = {codes_[n]})")
    acc, acc_cols = f"q_{names[0]}", [f"rs_x_{names[0]}"]
    for i, n in enumerate(names[1:], 1):
        parts.append(f"s2_{i} AS ({_ns_full(acc, f'q_{n}', k2, acc_cols, [f'rs_x_{n}'])})")
        acc, acc_cols = f"s2_{i}", acc_cols + [f"rs_x_{n}"]
    sel = ", ".join(["id AS l_orderkey"] + [f"rs_e_{n} AS {n}_entry" for n in names]
                    + [f"rs_x_{n} AS {n}_exit" for n in names])
    return "WITH " + ",\n".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in parts) + f"\nSELECT {sel} FROM {acc}"


@query("type_stage_wide_compat", _compat_sql())
def q_type_stage_wide_compat(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linestatus", "l_quantity",
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
         .when(F.col("l_returnflag") == "R", 3).alias("rtype"))
    return reshape.type_stage_wide(li, "l_orderkey", "l_linestatus", "rtype", "l_quantity",
                                   "F", "O", _FLAG_TYPES)


from . import csv_jobs, file_jobs  # noqa: E402,F401  register the extract jobs
