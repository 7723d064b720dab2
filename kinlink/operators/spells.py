"""Person-spell measures.

R's ``if_else`` keeps NA where a condition is NA; every rule here uses
``if_else3`` so the nulls land where the R code puts them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions import codes
from ..functions.nulls import if_else3, r_in
from ..session import materialize
from ._sequence import followed
from .aggregates import furthest_ends, union_days, with_totals


def next_values(df: DataFrame, part: str, first: str, rest: Sequence[tuple], cols: Sequence[str],
                prefix: str = "_n_", written: list | None = None, distinct: bool = False,
                apart: Sequence[str] = ()) -> DataFrame:
    """``lead`` of ``cols`` within ``part`` ordered by ``first`` (nulls last)
    then ``rest`` (``(column, nulls_last)`` pairs, ascending).

    The rows are sorted over ranges of (part, first, rest); each task reads
    the next row's values as it goes through its range, and the rows are
    written once.  A range's last row gets the first row of the next one,
    from a table of one row a range.  Ranges have about
    equal numbers of rows, whatever number a person or a date has.  Rows that
    agree in the whole order follow a hash of all their columns; null parts
    are one part.  The path of the written table is added to ``written``.

    ``distinct``: equal rows, which the order brings together, become one
    before.  ``apart`` names columns that only tell rows of an equal order
    apart: they become null where no row of the range beside has the same.
    """
    nested = [c for c, t in df.dtypes if t.startswith(("map", "array", "struct"))]
    if distinct and nested:
        df, distinct = df.distinct(), False
    order = [F.col(part).asc_nulls_first(), F.col(first).asc_nulls_last(),
             *[F.col(c).asc_nulls_last() if nl else F.col(c).asc_nulls_first() for c, nl in rest],
             F.xxhash64(*[c for c, t in df.dtypes if not t.startswith("map")])]
    # rows of an equal hash may differ: equal ones are neighbours once all columns are in the order
    ties = df.columns if distinct else []
    keys = [part, first, *[c for c, _ in rest]]
    kinds = {f.name: f.dataType for f in df.schema}
    schema = StructType([*[StructField(c, kind) for c, kind in kinds.items()], *[StructField(prefix + c, kinds[c]) for c in cols],
                         StructField("_begins", BooleanType()), StructField("_ends", BooleanType())])
    sorted_, path = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order, *ties)
          .mapInArrow(followed(part, list(cols), prefix, keys, list(apart), distinct), schema)
          .withColumn("_range", F.spark_partition_id()), "sequence")
    if written is not None:
        written.append(path)
    row = F.struct(F.col(part).alias("_part"), *cols)
    heads = sorted_.filter("_begins").select("_range", row.alias("_head"))
    # one row a range: this window and the broadcast are bounded by the number of partitions
    after = heads.select("_range", F.lead("_head").over(Window.orderBy("_range")).alias("_after"))
    out = sorted_.join(F.broadcast(after), "_range", "left")
    same = F.col("_after").isNotNull() & F.col("_after._part").eqNullSafe(F.col(part))
    return out.select(*df.columns, *[F.when(~F.col("_ends"), F.col(prefix + c)).when(same, F.col("_after")[c])
                                     .alias(prefix + c) for c in cols])


def age_and_relcode(df: DataFrame, entry: str = "entry", dob: str = "h_dob",
                    relcode: str = "relcode") -> DataFrame:
    """``h_age`` in years (days / 365.25); outside 0-120 nulls age and dob;
    missing relationship codes become null (``h_relcode``)."""
    age = F.datediff(F.col(entry), F.col(dob)) / F.lit(codes.DAYS_PER_YEAR)
    out_range = (age < 0) | (age > codes.AGE_MAX)
    h_age = if_else3(out_range, F.lit(None).cast("double"), age)
    rel = F.col(relcode).cast("string")
    h_rel = if_else3(rel.isin(codes.RELCODE_MISSING), F.lit(None).cast("string"), rel)
    # the R code tests the already-nulled age, so the date goes with it
    return (df.withColumn("h_age", h_age)
              .withColumn(dob, F.when(F.col("h_age").isNull(), F.lit(None)).otherwise(F.col(dob)))
              .withColumn("h_relcode", h_rel))


def child_elder_flags(df: DataFrame, relcode_when_no_age: bool = False) -> DataFrame:
    """``h_child`` (yes / relcode / no), age over 25 nulled for
    non-"no" rows, ``h_elder`` (yes / no / null)."""
    age, rel = F.col("h_age"), F.col("h_relcode")
    young = age < codes.CHILD_AGE
    no_age_y = (age.isNull() & (rel == "Y"))
    tail = if_else3(no_age_y, "relcode", if_else3((age >= codes.CHILD_AGE) & (rel == "Y"), "relcode", "no"))
    child = if_else3(young & (rel == "Y"), "yes",
                     if_else3(young & (rel == "F"), "yes",
                              if_else3(young & (rel == "2"), "yes", tail)))
    if relcode_when_no_age:
        child = F.when(no_age_y, F.lit("relcode")).otherwise(child)
    df = df.withColumn("h_child", child)
    capped = if_else3((F.col("h_child") != "no") & (age > codes.CHILD_AGE_CAP),
                      F.lit(None).cast("double"), age)
    df = df.withColumn("h_age", capped)
    is_no = F.col("h_child") == "no"
    elder = if_else3(is_no & (F.col("h_age") >= codes.ELDER_AGE), "yes",
                     if_else3(is_no & F.col("h_age").isNull(), F.lit(None).cast("string"), "no"))
    return df.withColumn("h_elder", elder)


def household_mix(df: DataFrame, hh: str = "hh_id", entry: str = "entry",
                  disability: str = "disability") -> DataFrame:
    """Size, kids, adults and household types per (household, entry).

    One ``groupBy`` with map-side combine, joined back on the group keys
    (null-safe, so rows with a null household still get their group's
    values); a household holding a large share of the rows never lands in
    one task the way a window partition would.
    """
    child, elder, dis = F.col("h_child"), F.col("h_elder") == "yes", F.col(disability) == "Disabled"

    def n_if(c):
        return F.sum(F.when(c, 1).otherwise(0))

    g = df.groupBy(F.col(hh).alias("_hh"), F.col(entry).alias("_en")).agg(
        F.count(F.lit(1)).alias("h_hh_ct"),
        n_if(child.isNull()).alias("_child_na"),
        n_if(child != "no").alias("_kids"), n_if(child == "no").alias("_adults"),
        n_if(elder).alias("_eld_t"), n_if(elder.isNull()).alias("_eld_na"),
        n_if(dis).alias("_dis_t"), n_if(dis.isNull()).alias("_dis_na"))
    kids = F.when(F.col("_child_na") > 0, F.lit(None)).otherwise(F.col("_kids"))
    adults = F.when(F.col("_child_na") > 0, F.lit(None)).otherwise(F.col("_adults"))
    elder_any = F.when(F.col("_eld_t") > 0, True).when(F.col("_eld_na") > 0, F.lit(None)).otherwise(False)
    dis_any = F.when(F.col("_dis_t") > 0, True).when(F.col("_dis_na") > 0, F.lit(None)).otherwise(False)
    t1 = if_else3(elder_any, "Elderly household", F.lit(None).cast("string"))
    t1 = if_else3(t1.isNull() & dis_any, "Non-elderly disabled household", t1)
    t1 = F.when(t1.isNull(), F.lit("Non-elderly non-disabled household")).otherwise(t1)
    g = g.select("_hh", "_en", "h_hh_ct", kids.alias("h_hh_kids"), adults.alias("h_hh_adults"),
                 t1.alias("h_hh_type1"))
    k, a = F.col("h_hh_kids"), F.col("h_hh_adults")
    t2 = if_else3((k > 0) & (a > 1), "multi-adult household with children",
                  if_else3((k > 0) & (a == 1), "single parent household with children",
                           if_else3((k == 0) & (a > 0), "household without children",
                                    F.lit(None).cast("string"))))
    g = g.withColumn("h_hh_type2", t2)
    cond = F.col(hh).eqNullSafe(F.col("_hh")) & F.col(entry).eqNullSafe(F.col("_en"))
    return df.join(g, cond, "left").drop("_hh", "_en")


def impute_exit(df: DataFrame, person: str = "linkage_PID", entry: str = "entry", exit: str = "exit",
                agency: str = "agency", proj_type: str = "hmis_proj_type",
                tiebreak: Sequence[str] = (), open_end: str = codes.OPEN_SPELL_END,
                short_days: int = codes.SHORT_STAY_DAYS,
                short_stay: Sequence[str] = codes.SHORT_STAY_PROJECTS, written: list | None = None,
                apart: Sequence[str] = ()) -> DataFrame:
    """E15 (with W1): ``h_exit`` for HMIS spells without an exit.

    Next entry / next exit come from ``lead`` over the person's spells in
    entry order (``tiebreak`` orders equal entries).  Outside the short-stay
    list: next entry when the next exit is known, else ``open_end``.  Short
    stay: entry + 90 unless the next exit is known and the next entry is
    under 90 days away, then the next entry.
    """
    df = next_values(df, person, entry, [(c, False) for c in tiebreak], [entry, exit], "_nx_", written, apart=apart)
    n_entry, n_exit = F.col("_nx_" + entry), F.col("_nx_" + exit)
    hmis_open = (F.col(agency) == "HMIS") & F.col(exit).isNull()
    short = r_in(F.col(proj_type), short_stay)
    gap = F.datediff(n_entry, F.col(entry))
    plus = F.date_add(F.col(entry), short_days)
    h_exit = if_else3(hmis_open & ~short & n_exit.isNotNull(), n_entry,
             if_else3(hmis_open & ~short & n_exit.isNull(), F.lit(open_end).cast("date"),
             if_else3(hmis_open & short & n_exit.isNotNull() & (gap >= short_days), plus,
             if_else3(hmis_open & short & n_exit.isNotNull() & (gap < short_days), n_entry,
             if_else3(hmis_open & short & n_exit.isNull(), plus, F.col(exit))))))
    return df.withColumn("h_exit", h_exit.cast("date")).drop("_nx_" + entry, "_nx_" + exit)


def service_days(df: DataFrame, person: str = "linkage_PID", agency: str = "agency",
                 entry: str = "entry", exit: str = "exit", written: list | None = None) -> DataFrame:
    """E16 + A12: service days, negative-spell swap, covered days, quality flag.

    Covered days (``h_agency_time`` per person and agency, ``h_tot_time`` per
    person) use the dates before negative spells are nulled.  The spells are
    written once; both totals come from one aggregation of them and are joined as one.
    """
    serv = F.datediff(F.col("h_exit"), F.col(entry))
    df = df.withColumn("h_servdays", serv).withColumn(
        "h_entry", if_else3(F.col("h_servdays") < 0, F.col(exit), F.col(entry)).cast("date"))
    df, path = materialize(df, "service")
    if written is not None:
        written.append(path)
    # a person has at most one row an agency and day here
    ends = furthest_ends(df, [person, agency], "h_entry", "h_exit").repartition(F.col(person))
    totals = with_totals(df.select(person, agency).distinct(), union_days(ends, [person, agency], "h_agency_time"), [person, agency], "h_agency_time")
    totals = with_totals(totals, union_days(ends, [person], "h_tot_time"), [person], "h_tot_time")
    totals = totals.select(person, agency, F.struct("h_agency_time", "h_tot_time").alias("_times"))
    df = (df.withColumnsRenamed({person: "_p", agency: "_a"})
            .join(totals, F.col("_p").eqNullSafe(F.col(person)) & F.col("_a").eqNullSafe(F.col(agency)), "left")
            .select(*[F.col("_p").alias(c) if c == person else F.col("_a").alias(c) if c == agency else F.col(c) for c in df.columns], "_times.*"))
    sd = if_else3(F.col("h_servdays") < 0, F.lit(None).cast("int"), F.col("h_servdays"))
    df = df.withColumn("h_servdays", sd)
    df = df.withColumn("h_exit", F.when(F.col("h_servdays").isNull(), F.lit(None)).otherwise(F.col("h_exit")))
    df = df.withColumn("h_entry", F.when(F.col("h_servdays").isNull(), F.lit(None)).otherwise(F.col(entry)))
    df = df.withColumn("h_servdays", F.datediff(F.col("h_exit"), F.col("h_entry")) + 1)
    return df.withColumn("h_time_qual", F.when(F.col("h_servdays").isNull(), 1).otherwise(0))


def transitions(df: DataFrame, person: str = "linkage_PID", agency: str = "agency",
                tiebreak: Sequence[str] = (), distinct: bool = False) -> DataFrame:
    """W2-W5 over the person's spells (``distinct``: equal ones count once) ordered by (h_entry, h_exit), nulls last."""
    df = next_values(df, person, "h_entry", [("h_exit", True)] + [(c, False) for c in tiebreak],
                     [agency, "h_entry", "h_exit"], "_tr_", distinct=distinct)
    n_agency, n_entry, n_exit = F.col("_tr_" + agency), F.col("_tr_h_entry"), F.col("_tr_h_exit")
    e, x = F.col("h_entry"), F.col("h_exit")
    return (df.withColumn("h_agency_trans", F.when(n_agency.isNull(), F.col(agency))
                          .otherwise(F.concat_ws(" to ", F.col(agency), n_agency)))
              .withColumn("h_t2next_prog", F.datediff(n_entry, x))
              .withColumn("h_overlap", (n_entry <= x) & (e <= n_exit))
              .withColumn("h_within", (n_entry >= e) & (n_exit <= x))
              .drop("_tr_" + agency, "_tr_h_entry", "_tr_h_exit"))
