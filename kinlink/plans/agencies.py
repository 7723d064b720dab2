"""Merge housing-authority and HMIS spells, household clusters,
person-spell frame.

Input column names follow the two agencies' extracts (HMIS wide table from
``plans.hmis.merge_tables``; housing-authority longitudinal file).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import recode as rc
from ..functions.nulls import r_in
from ..operators import aggregates as ag
from ..operators import graph, spells
from ..session import drop_materialized, materialize
from ..sources.readers import stack_by_name

HMIS_RACE = [("r_aian", "AmIndAKNative"), ("r_asian", "Asian"), ("r_black", "BlackAfAmerican"),
             ("r_nhpi", "NativeHIOtherPacific"), ("r_white", "White")]
PHA_PROGRAM = [("ha_maj_prog", "major_prog"), ("ha_prog_type", "prog_type"),
               ("ha_sub_type", "subsidy_type"), ("ha_vouch_type", "vouch_type_final"),
               ("ha_op_type", "operator_type"), ("ha_portfolio", "portfolio_final")]


def hmis_spells(hmis: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P17, P19, P21 for the HMIS wide table (one row per enrollment)."""
    return hmis.select(*keep,
        rc.prefixed_id("HMIS0_", F.col("PersonalID")).alias("pid0"),
        rc.prefixed_id("HMIS_", F.col("HouseholdID")).alias("hh_id"),
        F.col("RelationshipToHoH").cast("string").alias("relcode"),
        F.col("LastName").alias("lname"), F.col("FirstName").alias("fname"),
        F.col("MiddleName").alias("mname"),
        rc.gender_hmis(F.col("Gender")).alias("gender"),
        F.col("DOB").cast("date").alias("dob"),
        *[F.col(src).alias(dst) for dst, src in HMIS_RACE],
        F.col("Ethnicity").alias("r_ethnicity"),
        F.col("EntryDate").cast("date").alias("entry"),
        F.col("ExitDate").cast("date").alias("exit"),
        F.lit("HMIS").alias("agency"),
        F.col("ProjectType").alias("hmis_proj_type"),
        F.col("ProjectName").alias("hmis_proj_name"))


def pha_spells(pha: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """P17-P19, P21 for the housing-authority longitudinal file."""
    race = F.col("race_new")
    return pha.select(*keep,
        rc.prefixed_id("PHA0_", F.col("pid")).alias("pid0"),
        F.concat_ws("_", F.coalesce(F.col("agency_new").cast("string"), F.lit("NA")),
                    F.coalesce(F.col("hh_id_new").cast("string"), F.lit("NA"))).alias("hh_id"),
        F.col("relcode").cast("string").alias("relcode"),
        F.col("lname_new").alias("lname"), F.col("fname_new").alias("fname"),
        F.col("mname_new").alias("mname"),
        rc.gender_pha(F.col("gender2")).alias("gender"),
        F.col("dob").cast("date").alias("dob"),
        *[rc.race_flag(F.col(f"{flag}_new"), race, label).alias(flag) for flag, label in codes.RACE_ONLY],
        (race == F.lit(codes.RACE_MULTI)).cast("int").alias("r_multi"),
        F.col("r_hisp_new").alias("r_ethnicity"),
        F.col("disability2").alias("disability"),
        F.col("startdate").cast("date").alias("entry"),
        F.col("enddate").cast("date").alias("exit"),
        F.col("agency_new").alias("agency"),
        *[F.col(src).alias(dst) for dst, src in PHA_PROGRAM])


#: Digest of columns that are not asked for.
OTHERS = ("_others_a", "_others_b")
PROGRAMS = ("ha_prog_cat", "hmis_prog_cat")


def digest(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """128 bits of ``columns`` as ``OTHERS``: rows that differ in them only stay apart."""
    nested = {c for c, t in df.dtypes if t.startswith(("map", "array", "struct"))}
    values = [F.to_json(F.struct(c)) if c in nested else F.col(c) for c in columns]
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])    # a hash skips nulls
    return [F.xxhash64(F.lit(name), nulls, *values).alias(name) for name in OTHERS]


def merge_agencies(hmis: DataFrame, pha: DataFrame, links: DataFrame,
                   keep: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Stack both agencies, attach ``linkage_PID`` (J11), program strings (P20).

    ``links`` maps ``pid0`` to ``linkage_PID`` (plus ``pid1``/``pid2``);
    several links for one ``pid0`` multiply rows as in a left join.
    ``columns`` names those that are read later (default: all); the others
    become one digest before the join.
    """
    merged = stack_by_name([hmis_spells(hmis, keep), pha_spells(pha, keep)])
    if columns is not None and not {*columns} & {*PROGRAMS}:
        read = [c for c in merged.columns if c == "pid0" or c in columns]
        merged = merged.select(*read, *digest(merged, [c for c in merged.columns if c not in read]))
    lk = links.select("pid0", *[c for c in ("pid1", "pid2") if c in links.columns], "linkage_PID")
    merged = merged.join(lk, "pid0", "left")
    if OTHERS[0] in merged.columns:    # the program strings are made of columns in the digest
        return merged
    ha, hm = rc.program_category(
        F.col("agency"),
        [F.col("ha_sub_type"), F.col("ha_vouch_type"), F.col("ha_op_type"), F.col("ha_portfolio")],
        [F.col("hmis_proj_type"), F.col("hmis_proj_name")])
    return merged.withColumn("ha_prog_cat", ha).withColumn("hmis_prog_cat", hm)


def household_clusters(merged: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """E11 (G4 + A13): persons sharing a household id at any time.

    ``merged`` feeds edges, nodes, sizes and labels, so it is written once;
    of its columns those that the step needs, and ``columns`` (default: all).
    """
    if columns is not None:
        merged = merged.select([c for c in merged.columns if c in {"linkage_PID", "hh_id", *columns}])
    merged, _ = materialize(merged, "merged")
    return graph.household_clusters(merged, "linkage_PID", "hh_id")


def real_dob(merged: DataFrame, keep_ties: bool = False) -> DataFrame:
    """A7 for E12: modal birth date per person, housing-authority rows first;
    HMIS rows only for persons without housing-authority rows.

    One aggregation counts every (person, date) overall and on
    housing-authority rows; the pick per person runs on those counts.
    """
    is_pha = r_in(F.col("agency"), codes.PHA_AGENCIES)
    c = (merged.select("linkage_PID", F.col("dob").cast("date").alias("h_dob"), is_pha.alias("_pha"))
               .groupBy("linkage_PID", "h_dob")
               .agg(F.count(F.lit(1)).alias("_all"), F.sum(F.col("_pha").cast("int")).alias("_npha")))
    has_pha = F.max(F.col("_npha")).over(Window.partitionBy("linkage_PID")) > 0
    c = c.withColumn("n", F.when(has_pha, F.col("_npha")).otherwise(F.col("_all"))).filter("n > 0")
    return ag.mode_from_counts(c.select("linkage_PID", "h_dob", "n"), "linkage_PID", "h_dob", "n",
                               keep_ties).drop("n")


#: Columns that the steps of a person-spell frame read on the way.
_SPELL_INPUTS = ("dob", "relcode", "hh_id", "disability", "hmis_proj_type")
SPELL_COLUMNS = ("linkage_PID", "agency", "entry", "exit", *_SPELL_INPUTS)


def person_spell_frame(merged: DataFrame, min_entry: str = codes.SPELL_MIN_ENTRY,
                       keep_ties: bool = False, tiebreak: Sequence[str] = ("pid0",),
                       relcode_when_no_age: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per linked person and spell with age, household, exit
    imputation, service days, covered days and transitions.

    ``merged`` is written once, so that the birth dates and the rows come
    from one computation.  The per-person steps work on ranges of spells sorted
    by person and date, which split hot persons (``next_values``), and on one row a
    person and day (covered days).  A table of a step is removed once
    the next one is written; the last lies in the checkpoint folder until
    ``session.clear_materialized``.

    ``columns`` names the columns of ``merged`` to return (default: all).
    The others go along as long as a step reads them, and as one digest
    until the first sort shows which rows it has to tell apart.
    """
    tb, spark = list(tiebreak), merged.sparkSession
    kept = list(merged.columns) if columns is None else [c for c in merged.columns if c in {"linkage_PID", "agency", "entry", "exit", *tb, *columns}]
    gone = [c for c in merged.columns if c not in kept]
    others = list(OTHERS) if gone else []
    if gone:
        merged = merged.select(*kept, *[c for c in gone if c in _SPELL_INPUTS], *digest(merged, gone))

    def without(df: DataFrame, *names: str) -> DataFrame:
        return df.drop(*[c for c in names if c in gone])

    merged, first = materialize(merged, "merged")
    df = merged.join(real_dob(merged, keep_ties), "linkage_PID", "left")
    df = df.filter(F.col("linkage_PID").isNotNull() & (F.col("entry") >= F.lit(min_entry).cast("date")))
    df = without(spells.age_and_relcode(without(df, "dob")), "relcode")
    df = spells.child_elder_flags(df, relcode_when_no_age)
    written: list[str] = []
    df = without(spells.impute_exit(df, tiebreak=tb, written=written, apart=others), "hmis_proj_type")
    drop_materialized(spark, first)
    df = without(spells.household_mix(df), "hh_id", "disability")
    df = spells.service_days(df, written=written)
    drop_materialized(spark, written[0])
    df = spells.transitions(df, tiebreak=tb, distinct=True)
    drop_materialized(spark, written[1])
    return df.drop(*others)
