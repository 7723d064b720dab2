"""Extract jobs on real files: folders of CSV in the checkpoint folder, and sinks that are read again.

The test tables are written as the extracts would come (a byte-order mark,
another encoding, line breaks in quotes, columns that differ by year), read
through S1-S7, and results go through S8 and S9.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.readers import COUNTY_FOLDERS
from ..sources.writers import numbered_rows, write_table
from . import hmis
from .catalog import iso, query, table


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/kinlink-files-{uuid.uuid4().hex}"


def _enrollment_meta(spark, root: str, **more) -> str:
    """A configuration file, with the ``name`` that S5 discards."""
    meta = {"name": "Enrollment", "person_enrollment_ID": "id", "groupID_column": "hh", "duplicate_check_columns": ["id", "hh"],
            "time_var": ["entry"], "columns_to_drop": ["skipped", "not there"], **more}
    write_table(spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1), f"{root}/meta", fmt="text")
    return f"{root}/meta"


def _years(spark, d, root: str, **how) -> None:
    """Five yearly folders of orders: an order is in the folder of its year and, every third one, in the next
    year's too, where the priority reads otherwise; columns differ by year."""
    o = table(spark, d, "orders")
    year = F.pmod(F.col("o_orderkey"), F.lit(5))
    for i, folder in enumerate(COUNTY_FOLDERS["king"]):
        again = (year == i - 1) & (F.col("o_orderkey") % 3 == 0)
        note = F.concat(F.lit("caf\u00e9 \"no. "), F.col("o_orderkey").cast("string"), F.lit("\"\nsecond line, "),
                        F.when(again, F.concat(F.lit("late "), F.lit(str(i)))).otherwise(F.col("o_orderpriority")))
        rows = o.filter((year == i) | again).select(
            F.col("o_orderkey").cast("string").alias("\ufeffid" if how.get("mark") else "id"),
            F.concat(F.col("o_custkey").cast("string"), F.lit(".0" if i % 2 else "")).alias("hh"),
            F.col("o_orderdate").cast("string").alias("entry"), note.alias("note"),
            *([F.lit("x").alias("skipped")] if i != 1 else []), *([F.col("o_orderstatus").alias("status")] if i >= 2 else []))
        rows.write.option("header", True).option("escape", '"').option("encoding", how.get("encoding", "UTF-8")).csv(f"{root}/{folder}/Enrollment.csv")


_YEARS_SQL = """
WITH y AS (SELECT *, o_orderkey % 5 AS i FROM orders),
files AS (SELECT *, i AS f, o_orderpriority AS word FROM y UNION ALL
          SELECT *, i + 1, 'late ' || (i + 1) FROM y WHERE o_orderkey % 3 = 0 AND i < 4),
kept AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY f DESC) AS rn FROM files),
one AS (SELECT * FROM kept WHERE rn = 1),
big AS (SELECT o_custkey FROM one WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1),
res AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS hh, strftime(o_orderdate, '%Y-%m-%d') AS entry,
               'caf\u00e9 "no. ' || o_orderkey || '"' || chr(10) || 'second line, ' || word AS note,
               CASE WHEN f >= 2 THEN o_orderstatus END AS status
        FROM one WHERE o_custkey IN (SELECT o_custkey FROM big))
"""


def _read_years(spark, d, encoding: str, mark: bool, **how) -> DataFrame:
    root = _folder(spark)
    _years(spark, d, root, encoding=encoding, mark=mark)
    meta = _enrollment_meta(spark, root)
    return hmis.get_enrollment(spark, county="king", data_dir=root, metadata=meta, encoding=encoding, multi_line=True, **how)


# ------------------------------------------------- S1-S7, P1, P2, E1 on files --
@query("read_county_folders", _YEARS_SQL + "SELECT * FROM res")
def q_read_county_folders(spark, d):
    """Five yearly CSV folders with byte-order marks, line breaks in quotes and differing columns."""
    e = _read_years(spark, d, "UTF-8", True)
    return e.select("id", "hh", iso("entry").alias("entry"), "note", "status")


@query("read_latin1_folders", _YEARS_SQL + "SELECT * FROM res")
def q_read_latin1_folders(spark, d):
    """The same folders in ISO-8859-1."""
    e = _read_years(spark, d, "ISO-8859-1", False)
    return e.select("id", "hh", iso("entry").alias("entry"), "note", "status")


# --------------------------------------------------------------------- O1, A2 --
@query("sorted_sink", _YEARS_SQL + "SELECT row_number() OVER (ORDER BY hh) AS row_number, hh FROM res")
def q_sorted_sink(spark, d):
    """O1, A2: enrollments sorted by household, written, and read with each row's place in the files."""
    root = _folder(spark)
    write_table(_read_years(spark, d, "UTF-8", True, sort=True), f"{root}/sorted")
    return numbered_rows(spark, f"{root}/sorted").select("row_number", "hh")


# --------------------------------------------------------------------- S8, S9 --
@query("partitioned_sink", """
SELECT o_orderkey, o_custkey, 'F' AS agency, 'plain "quoted", ' || o_orderpriority AS pri FROM orders WHERE o_orderstatus = 'F'
""")
def q_partitioned_sink(spark, d):
    """One CSV hand-off file set, read again into a table partitioned by agency; one agency is read."""
    root = _folder(spark)
    pri = F.concat(F.lit('plain "quoted", '), F.col("o_orderpriority"))
    write_table(table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("agency"), pri.alias("pri")),
                f"{root}/handoff", fmt="csv")
    back = spark.read.schema("o_orderkey long, o_custkey long, agency string, pri string").csv(f"{root}/handoff", header=True, escape='"')
    write_table(back, f"{root}/merged", partition_by=["agency"])
    return spark.read.parquet(f"{root}/merged").filter(F.col("agency") == "F").select("o_orderkey", "o_custkey", "agency", "pri")
