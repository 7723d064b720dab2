"""Pre-link table (identity variants of both agencies, ready for L4).

Per agency: distinct identity rows, SSN and birth-date quality codes, date
parts, upper-case names, per-source sequence ids (``pid1``); then both
stacked with an overall id (``pid2``), usable SSN / birth date columns, and
rows with refused names removed.  Frequent or impossible birth dates (A6)
are computed over the whole source table and applied through a join.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import recode as rc
from ..operators import aggregates as ag
from ..operators.graph import dense_ids
from ..sources.readers import stack_by_name

NAME_COLS = ["lname", "fname", "mname", "suf"]


def _bad_dob_flag(df: DataFrame, src: DataFrame, dob_src: str, min_freq: int) -> DataFrame:
    """``dob_dq`` = 2 when the date is on the A6 list of ``src``, else 1."""
    bad = ag.frequent_values(src, dob_src, min_freq).select(F.col("value").alias("_bad"))
    j = df.join(bad, F.col("dob") == F.col("_bad"), "left")
    return j.withColumn("dob_dq", F.when(F.col("_bad").isNotNull(), 2).otherwise(1)).drop("_bad")


def _finish_source(df: DataFrame, prefix: str, order: Sequence[str]) -> DataFrame:
    df = rc.date_parts(df, "dob")
    df = dense_ids(df, list(order), out="_seq")
    df = df.withColumn("pid1", rc.seq_id(prefix, F.col("_seq")))
    df = rc.upper_cols(df, NAME_COLS)
    return rc.null_tokens(df, NAME_COLS, tokens=[""])


def pha_variants(pha: DataFrame, cols: Mapping[str, str], min_freq: int = codes.BAD_DOB_FREQ_PHA,
                 order: Sequence[str] = ("pid0",)) -> DataFrame:
    """Housing-authority identities; ``cols`` maps pid0/ssn/lname/fname/mname/suf/dob/gen to source columns."""
    sel = pha.select(*[F.col(v).alias(k) for k, v in cols.items()]).distinct()
    sel = sel.withColumn("gen", rc.gender_prelink(F.col("gen"))) \
             .withColumn("ssn", F.col("ssn").cast("string").try_cast("double").cast("bigint")) \
             .withColumn("ssn_dq", rc.ssn_quality_pha(F.col("ssn"))) \
             .withColumn("dob", F.col("dob").cast("date"))
    sel = _bad_dob_flag(sel, pha.select(F.col(cols["dob"]).cast("date").alias("d")), "d", min_freq)
    return _finish_source(sel, "pha1_", order).withColumn("_src", F.lit(0))


def hmis_variants(hmis: DataFrame, cols: Mapping[str, str], min_freq: int = codes.BAD_DOB_FREQ_HMIS,
                  order: Sequence[str] = ("pid0",)) -> DataFrame:
    """HMIS identities; ``cols`` also maps ``ssn_dq`` (SSNDataQuality)."""
    sel = hmis.select(*[F.col(v).alias(k) for k, v in cols.items()]).distinct()
    sel = sel.withColumn("ssn", F.col("ssn").cast("string").try_cast("double").cast("bigint")) \
             .withColumn("dob", F.col("dob").cast("date")) \
             .withColumn("ssn_dq", rc.ssn_quality_hmis(F.col("ssn_dq")))
    sel = _bad_dob_flag(sel, hmis.select(F.col(cols["dob"]).cast("date").alias("d")), "d", min_freq)
    return _finish_source(sel, "hmis1_", order).withColumn("_src", F.lit(1))


def prelink_table(pha_ids: DataFrame, hmis_ids: DataFrame) -> DataFrame:
    """Stack both sources (housing authority first), overall ``pid2``, usable
    SSN and birth date, refused names removed (P10)."""
    # the overall id goes on after the first source's last one: a count, no sort
    after = pha_ids.agg(F.coalesce(F.max("_seq"), F.lit(0))).first()[0]
    df = stack_by_name([pha_ids, hmis_ids])
    df = df.withColumn("ssn_dq", rc.ssn_repeated_digit(F.col("ssn"), F.col("ssn_dq")))
    df = df.withColumn("_all", F.col("_seq") + F.when(F.col("_src") == 1, F.lit(after)).otherwise(F.lit(0)))
    df = df.withColumn("pid2", rc.seq_id("pid2_", F.col("_all")))
    df = df.withColumn("ssn1", rc.usable_ssn(F.col("ssn"), F.col("ssn_dq")).cast("bigint"))
    df = df.withColumn("dob1", rc.usable_dob(F.col("dob"), F.col("dob_dq")))
    df = rc.date_parts(df, "dob1")
    df = df.filter(rc.refused_name_keep(["lname", "fname"]))
    return df.drop("_seq", "_all", "_src")
