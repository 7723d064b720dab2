"""The extract jobs E1-E8 on the shared test tables, passed in as files of text.

Each table plays one extract: columns are text as a CSV reader gives them
(ids also as "7.0", numbers with differing digit counts), and two files a
table where precedence matters.  The SQL beside each query restates the
job's rules on the typed tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from . import hmis
from .catalog import (_DEST_VALUES, _PROJ_VALUES, SQL, _compat_sql, iso, query, table)

STAGE = {"collection_stage_column": "stage", "entry_stage_val": 1, "exit_stage_val": 3, "update_stage_val": 2,
         "annual_assessment_stage_val": 5, "post_exit_stage_val": 6, "person_enrollment_ID": "id"}


def _text(df: DataFrame, **cols) -> DataFrame:
    return df.select(*[(F.col(c) if isinstance(c, str) else c).cast("string").alias(n) for n, c in cols.items()])


# -------------------------------------------------------------- S2, S3, E1 --
@query("get_enrollment", """
WITH both_files AS (
  SELECT o_orderkey AS id, o_custkey AS hh, o_orderdate AS entry, o_orderpriority AS pri, 0 AS f FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderdate, 'second file', 1 FROM orders WHERE o_totalprice > 100000),
kept AS (SELECT *, row_number() OVER (PARTITION BY id, hh ORDER BY f DESC) AS rn FROM both_files),
big AS (SELECT hh FROM kept WHERE rn = 1 AND hh IS NOT NULL GROUP BY hh HAVING count(*) > 1)
SELECT CAST(id AS VARCHAR) AS id, CAST(hh AS VARCHAR) AS hh, strftime(entry, '%Y-%m-%d') AS entry, pri
FROM kept WHERE rn = 1 AND hh IN (SELECT hh FROM big)
""")
def q_get_enrollment(spark, d):
    """E1 over two files; the second writes its ids as ``7.0`` and wins."""
    o = table(spark, d, "orders")
    first = _text(o, id="o_orderkey", hh="o_custkey", entry="o_orderdate", pri="o_orderpriority", skipped="o_orderstatus")
    second = _text(o.filter("o_totalprice > 100000"), id=F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")), hh="o_custkey",
                   entry="o_orderdate", pri=F.lit("second file"))
    meta = {"person_enrollment_ID": "id", "groupID_column": "hh", "duplicate_check_columns": ["id", "hh"], "time_var": ["entry"],
            "columns_to_drop": ["skipped"]}
    e = hmis.get_enrollment(spark, file_spec={"first": first, "second": second}, metadata=meta)
    return e.select("id", "hh", iso("entry").alias("entry"), "pri")


# ---------------------------------------------------------------------- E2 --
@query("get_exit", f"""
WITH x AS (SELECT DISTINCT l_orderkey AS id, CAST(l_quantity AS INTEGER) AS dest FROM lineitem)
SELECT CAST(x.id AS VARCHAR) AS id, v.* FROM x LEFT JOIN (VALUES {_DEST_VALUES})
  AS v(DestinationNumeric, DestinationDescription, DestinationGroup, DestinationSuccess, Subsidy)
  ON x.dest = v.DestinationNumeric
""")
def q_get_exit(spark, d):
    x = _text(table(spark, d, "lineitem"), id="l_orderkey", dest=F.col("l_quantity").cast("double"))
    return hmis.get_exit(spark, file_spec={"x": x}, metadata={
        "person_enrollment_ID": "id", "destination_column": "dest", "duplicate_check_columns": ["id", "dest"]})


# ---------------------------------------------------------------------- E3 --
@query("get_client", SQL["client_resolve"].replace("SELECT o_custkey, o_orderpriority", "SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority"))
def q_get_client(spark, d):
    """Order rows as client rows; persons' conflicting dates, flags and codes are settled."""
    from .catalog import _code, _flag
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderpriority", "o_orderdate",
                                         _flag().alias("flag"), _code().alias("code"))
    c = hmis.get_client(spark, file_spec={"x": o.orderBy("o_orderkey")}, metadata={
        "person_ID": "o_custkey", "duplicate_check_columns": ["o_custkey", "o_orderpriority"],
        "time_var": ["o_orderdate"], "boolean": ["flag"], "numeric_code": ["code"]})
    return c.select("o_custkey", "o_orderpriority", "o_orderkey", iso("o_orderdate").alias("o_orderdate"), "flag", "code")


# --------------------------------------------------------------- R2, E5, E6 --
def _stages(spark, d, **cols) -> DataFrame:
    """Line items as stage rows: stage 1 ("1.0") for status F, 3 for O, and stages that drop out for part of both."""
    li = table(spark, d, "lineitem")
    stage = (F.when(F.col("l_linenumber") == 7, "2").when(F.col("l_linenumber") == 6, "other")
             .when(F.col("l_linestatus") == "F", "1.0").otherwise("3"))
    return _text(li, id="l_orderkey", stage=stage, **cols)


_STAGE_SQL = """st AS (SELECT l_orderkey AS id, CASE WHEN l_linenumber = 7 THEN 2 WHEN l_linenumber = 6 THEN NULL
                             WHEN l_linestatus = 'F' THEN 1 ELSE 3 END AS stage, * FROM lineitem)"""


def _split_sql(value: str) -> str:
    return f"""
WITH {_STAGE_SQL},
e AS (SELECT DISTINCT id, {value} AS v FROM st WHERE stage = 1),
x AS (SELECT DISTINCT id, {value} AS v FROM st WHERE stage = 3)
SELECT CAST(coalesce(e.id, x.id) AS VARCHAR) AS id, e.v AS value_entry, x.v AS value_exit FROM e FULL JOIN x ON e.id = x.id
"""


@query("get_employment_education", _split_sql("l_returnflag"))
def q_get_employment_education(spark, d):
    return hmis.get_employment_education(spark, file_spec={"x": _stages(spark, d, value="l_returnflag")}, metadata={
        **STAGE, "duplicate_check_columns": ["id", "stage", "value"]})


@query("get_health_dv", f"""
WITH {_STAGE_SQL},
e AS (SELECT DISTINCT id, l_linenumber AS code FROM st WHERE stage = 1),
x AS (SELECT DISTINCT id, l_linenumber AS code FROM st WHERE stage = 3)
SELECT CAST(coalesce(e.id, x.id) AS VARCHAR) AS id, CASE WHEN e.code = 3 THEN NULL ELSE e.code END AS value_entry,
       CASE WHEN x.code = 3 THEN NULL ELSE x.code END AS value_exit FROM e FULL JOIN x ON e.id = x.id
""")
def q_get_health_dv(spark, d):
    return hmis.get_health_dv(spark, file_spec={"x": _stages(spark, d, value="l_linenumber")}, metadata={
        **STAGE, "categorical_var": ["value"], "duplicate_check_columns": ["id", "stage", "value"]},
        categorical_unknown=[3])


# ---------------------------------------------------------------------- E7 --
@query("get_income", f"""
WITH {_STAGE_SQL}
SELECT CAST(id AS VARCHAR) AS id, max(CASE WHEN stage = 1 THEN CAST(l_quantity AS DOUBLE) END) AS amount_entry,
       max(CASE WHEN stage = 3 THEN CAST(l_quantity AS DOUBLE) END) AS amount_exit
FROM st WHERE stage IN (1, 3) GROUP BY id
""")
def q_get_income(spark, d):
    """Amounts of one to two digits as text; many enrollments answer alike."""
    return hmis.get_income(spark, file_spec={"x": _stages(spark, d, amount=F.col("l_quantity").cast("int"))}, metadata={
        **STAGE, "columns_to_take_max": ["amount"], "duplicate_check_columns": ["id", "stage", "amount"]})


# ---------------------------------------------------------------------- E4 --
#: Types 5 to 10 are listed, 11 is not; lines of one order share types now and then.
_SIX_TYPES = "5 + (l_partkey + l_linenumber) % 7"


@query("get_disabilities", _compat_sql(distinct=True, types=codes.DISABILITY_TYPES, kind=_SIX_TYPES, response="l_quantity % 5").replace(
    "id AS l_orderkey", "CAST(id AS VARCHAR) AS id", 1))
def q_get_disabilities(spark, d):
    """E4 with all six types: line items as responses; several responses of a type multiply rows."""
    x = _text(table(spark, d, "lineitem"), id="l_orderkey", stage=F.when(F.col("l_linestatus") == "F", "1.0").otherwise("3"),
              type=F.concat(F.expr(_SIX_TYPES).cast("string"), F.when(F.col("l_linenumber") == 2, ".0").otherwise("")),
              response=(F.col("l_quantity") % 5).cast("int"))
    return hmis.get_disabilities(spark, file_spec={"x": x}, metadata={
        **STAGE, "type_column": "type", "response_column": "response", "categorical_var": ["response"],
        "duplicate_check_columns": ["id", "stage", "type", "response"]}, categorical_unknown=[])


# ---------------------------------------------------------------------- E8 --
@query("get_project", f"""
SELECT CAST(p.p_partkey AS VARCHAR) AS id, p.p_name AS name, t.ProjectNumeric, t.ProjectType
FROM part p LEFT JOIN (VALUES {_PROJ_VALUES}) AS t(ProjectNumeric, ProjectType) ON p.p_size = t.ProjectNumeric
""")
def q_get_project(spark, d):
    p = _text(table(spark, d, "part"), id="p_partkey", name="p_name", ProjectType=F.concat(F.col("p_size").cast("string"), F.lit(".0")))
    return hmis.get_project(spark, file_spec={"x": p}, metadata={
        "program_ID": "id", "project_type_column": "ProjectType", "duplicate_check_columns": ["id", "name", "ProjectType"]})


# ---------------------------------------------------------------------- E9 --
_DIS_SQL = _compat_sql(distinct=True, types=codes.DISABILITY_TYPES, kind=_SIX_TYPES, response="l_quantity % 5")
_DIS_NAMES = [f"{name}{sfx}" for sfx in ("_entry", "_exit") for _, name in codes.DISABILITY_TYPES]
_DIS_COLUMNS = ", ".join(f"dis.{c}" for c in _DIS_NAMES)


@query("merge_tables", f"""
WITH dis AS ({_DIS_SQL}),
st AS (SELECT l_orderkey AS id, l_linestatus AS st, CAST(max(l_quantity) AS BIGINT) AS amount, min(l_returnflag) AS flag
            FROM lineitem GROUP BY ALL),
e AS (SELECT * FROM st WHERE st = 'F'), x AS (SELECT * FROM st WHERE st = 'O'),
first AS (SELECT o_custkey, min(o_orderdate) AS first_entry FROM orders GROUP BY o_custkey),
client AS (SELECT c_custkey, CAST(DATE '1880-01-01' + CAST(c_custkey * 97 % 45000 AS INTEGER) AS TIMESTAMP) AS dob FROM customer),
fixed AS (SELECT c.c_custkey, CASE WHEN date_part('year', dob) < 1900 OR dob > first_entry THEN NULL ELSE dob END AS dob
          FROM client c LEFT JOIN first f ON c.c_custkey = f.o_custkey)
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, CAST(c.c_custkey AS VARCHAR) AS pid, strftime(o.o_orderdate, '%Y-%m-%d') AS entry,
       strftime(c.dob, '%Y-%m-%d') AS dob, d.DestinationGroup, d.Subsidy,
       {_DIS_COLUMNS},
       e.flag AS employed_entry, x.flag AS employed_exit, e.flag AS health_entry, x.flag AS health_exit,
       CAST(e.amount AS DOUBLE) AS income_entry, CAST(x.amount AS DOUBLE) AS income_exit, t.ProjectType
FROM fixed c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
LEFT JOIN (VALUES {_DEST_VALUES}) AS d(DestinationNumeric, DestinationDescription, DestinationGroup, DestinationSuccess, Subsidy)
  ON o.o_orderkey % 31 = d.DestinationNumeric
LEFT JOIN dis ON o.o_orderkey = dis.l_orderkey LEFT JOIN e ON o.o_orderkey = e.id LEFT JOIN x ON o.o_orderkey = x.id
LEFT JOIN (VALUES {_PROJ_VALUES}) AS t(ProjectNumeric, ProjectType) ON o.o_orderkey % 20 % 15 = t.ProjectNumeric
""")
def q_merge_tables(spark, d):
    """Orders as enrollments and exits, customers as clients, line items as the four stage tables."""
    meta, files = _extracts(spark, d)
    m = hmis.merge_tables(spark, meta_files=meta, files=files, groups=False)
    return m.select("id", "pid", iso("entry").alias("entry"), iso("dob").alias("dob"), "DestinationGroup", "Subsidy",
                    *_DIS_NAMES, "employed_entry", "employed_exit", "health_entry", "health_exit",
                    "income_entry", "income_exit", "ProjectType")


def _extracts(spark, d) -> tuple[dict, dict]:
    """Configurations and files of the eight tables."""
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    st = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linestatus").agg(
        F.max("l_quantity").cast("bigint").alias("amount"), F.min("l_returnflag").alias("flag"))
    stage = F.when(F.col("l_linestatus") == "F", "1.0").otherwise("3")
    born = F.date_add(F.lit("1880-01-01").cast("date"), (F.col("c_custkey") * 97 % 45000).cast("int"))
    files = {
        "enrollment": _text(o, id="o_orderkey", pid="o_custkey", prog=key % 20, grp="o_custkey", entry="o_orderdate"),
        "exit": _text(o, id=F.concat(key.cast("string"), F.lit(".0")), dest=key % 31),
        "client": _text(table(spark, d, "customer"), pid="c_custkey", dob=born),
        "disabilities": _text(table(spark, d, "lineitem"), id="l_orderkey", stage=stage, type=F.expr(_SIX_TYPES),
                              response=(F.col("l_quantity") % 5).cast("int")),
        "employment_education": _text(st, id="l_orderkey", stage=stage, employed="flag"),
        "health_dv": _text(st, id="l_orderkey", stage=stage, health="flag"),
        "income": _text(st, id="l_orderkey", stage=stage, income="amount"),
        "project": _text(o.select((key % 20).alias("p")).distinct(), prog="p", kind=F.col("p") % 15),
    }
    meta = {
        "enrollment": {"person_enrollment_ID": "id", "person_ID": "pid", "program_ID": "prog", "groupID_column": "grp",
                       "entry_date": "entry", "time_var": ["entry"], "duplicate_check_columns": ["id"]},
        "exit": {"person_enrollment_ID": "id", "destination_column": "dest", "duplicate_check_columns": ["id"]},
        "client": {"person_ID": "pid", "dob_column": "dob", "time_var": ["dob"], "duplicate_check_columns": ["pid", "dob"]},
        "disabilities": {**STAGE, "type_column": "type", "response_column": "response", "categorical_var": ["response"],
                         "categorical_unknown": [], "duplicate_check_columns": ["id", "stage", "type", "response"]},
        "employment_education": {**STAGE, "duplicate_check_columns": ["id", "stage"]},
        "health_dv": {**STAGE, "duplicate_check_columns": ["id", "stage"]},
        "income": {**STAGE, "columns_to_take_max": ["income"], "duplicate_check_columns": ["id", "stage"]},
        "project": {"program_ID": "prog", "project_type_column": "kind", "duplicate_check_columns": ["prog"]},
    }
    return meta, {k: {"x": v} for k, v in files.items()}


# --------------------------------------------------------------- A5, D10 --
@query("merge_counts", f"""
WITH st AS (SELECT DISTINCT l_orderkey AS id FROM lineitem), dis AS ({_DIS_SQL}),
first AS (SELECT o_custkey, min(o_orderdate) AS first_entry FROM orders GROUP BY o_custkey),
client AS (SELECT c_custkey, CAST(DATE '1880-01-01' + CAST(c_custkey * 97 % 45000 AS INTEGER) AS TIMESTAMP) AS dob FROM customer)
SELECT 'rows_enrollment' AS metric, count(*) AS n FROM orders UNION ALL SELECT 'rows_exit', count(*) FROM orders
UNION ALL SELECT 'rows_client', count(*) FROM customer UNION ALL SELECT 'rows_disabilities', count(*) FROM dis
UNION ALL SELECT 'rows_employment_education', count(*) FROM st UNION ALL SELECT 'rows_health_dv', count(*) FROM st
UNION ALL SELECT 'rows_income', count(*) FROM st UNION ALL SELECT 'rows_project', count(DISTINCT o_orderkey % 20) FROM orders
UNION ALL SELECT 'n_bad_dob', count(*) FROM client c LEFT JOIN first f ON c.c_custkey = f.o_custkey
          WHERE date_part('year', dob) < 1900 OR dob > first_entry
""")
def q_merge_counts(spark, d):
    """The counts that a merge reports, gathered while its result is written."""
    meta, files = _extracts(spark, d)
    return hmis.merge_counts(spark, meta_files=meta, files=files, groups=False)[1]
