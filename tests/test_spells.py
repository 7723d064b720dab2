"""Hand-computed cases."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from kinlink.operators import aggregates as ag
from kinlink.operators import spells
from kinlink.plans import agencies

D0 = dt.date(2010, 1, 1)


def d(n):
    return D0 + dt.timedelta(days=n)


def test_covered_days_union(spark):  # A12
    iv = [(1, d(0), d(10)), (1, d(5), d(8)), (1, d(10), d(12)), (1, d(20), d(21)), (1, d(30), None),
          (2, d(3), d(3))]
    df = spark.createDataFrame(iv, "p int, s date, e date")
    got = {r.p: r.covered_days for r in ag.covered_days(df, ["p"], "s", "e").collect()}
    assert got == {1: 13, 2: 0}


def test_covered_days_random_vs_set(spark):  # A12 invariant
    import random
    rnd = random.Random(7)
    iv = []
    for p in range(20):
        for _ in range(rnd.randint(1, 8)):
            a = rnd.randint(0, 60)
            iv.append((p, d(a), d(a + rnd.randint(0, 15))))
    exp = {}
    for p, s, e in iv:
        exp.setdefault(p, set()).update((s + dt.timedelta(days=k)) for k in range((e - s).days))
    df = spark.createDataFrame(iv, "p int, s date, e date")
    got = {r.p: r.covered_days for r in ag.covered_days(df, ["p"], "s", "e").collect()}
    assert got == {p: len(v) for p, v in exp.items()}


def test_child_flags(spark):  # E13, E14
    rows = [(1, d(0), None, "Y"), (2, d(0), d(-365 * 10), "Y"), (3, d(0), d(-365 * 30), "Y"),
            (4, d(0), d(-365 * 70), None), (5, d(0), d(-365 * 70), "99"), (6, d(0), d(-365 * 200), "F"),
            (7, d(0), d(-365 * 40), "2")]
    df = spark.createDataFrame(rows, "id int, entry date, h_dob date, relcode string")
    out = spells.child_elder_flags(spells.age_and_relcode(df))
    got = {r.id: (r.h_child, r.h_elder, r.h_age is None) for r in out.collect()}
    assert got[1] == (None, None, True)          # age missing and code Y: null flag (R's NA)
    assert got[2] == ("yes", "no", False)
    assert got[3] == ("relcode", "no", True)     # adult with code Y: age over 25 nulled
    assert got[4][0] is None                     # null code: undecided
    assert got[6] == (None, None, True)          # age over 120 -> no age, no dob
    assert got[7] == ("no", "no", False)         # 40 years, code 2 -> adult
    flag = spells.child_elder_flags(spells.age_and_relcode(df), relcode_when_no_age=True)
    assert {r.id: r.h_child for r in flag.collect()}[1] == "relcode"


def test_household_mix(spark):  # A8-A11
    rows = [("h1", d(0), "no", "yes", "Not"), ("h1", d(0), "yes", "no", "Not"),
            ("h2", d(0), "no", "no", "Disabled"), ("h2", d(0), "no", "no", "Not"), ("h2", d(0), "yes", "no", "Not"),
            ("h3", d(0), None, None, "Not"), ("h3", d(0), "no", "no", None)]
    df = spark.createDataFrame(rows, "hh_id string, entry date, h_child string, h_elder string, disability string")
    got = {r.hh_id: (r.h_hh_ct, r.h_hh_kids, r.h_hh_adults, r.h_hh_type1, r.h_hh_type2)
           for r in spells.household_mix(df).collect()}
    assert got["h1"] == (2, 1, 1, "Elderly household", "single parent household with children")
    assert got["h2"] == (3, 1, 2, "Non-elderly disabled household", "multi-adult household with children")
    assert got["h3"] == (2, None, None, "Non-elderly non-disabled household", None)


def test_impute_exit(spark):  # E15, W1
    rows = [(1, "HMIS", "Emergency Shelter", d(0), None), (1, "HMIS", "Transitional Housing", d(30), d(50)),
            (2, "HMIS", "Emergency Shelter", d(0), None), (2, "SHA", None, d(100), d(150)),
            (3, "HMIS", "Emergency Shelter", d(0), None),
            (4, "HMIS", None, d(0), None), (4, "HMIS", None, d(10), None),
            (5, "HMIS", "Transitional Housing", d(0), None), (5, "KCHA", None, d(7), d(9))]
    df = spark.createDataFrame(rows, "linkage_PID int, agency string, hmis_proj_type string, entry date, exit date")
    got = {(r.linkage_PID, r.entry): r.h_exit for r in spells.impute_exit(df).collect()}
    assert got[(1, d(0))] == d(30)               # short stay, next entry within 90 days
    assert got[(2, d(0))] == d(90)               # short stay, next entry 100 days away
    assert got[(3, d(0))] == d(90)               # short stay, no next spell
    assert got[(4, d(0))] == dt.date(2017, 12, 31)  # next spell itself open
    assert got[(5, d(0))] == d(7)                # long stay: next entry
    assert got[(1, d(30))] == d(50)


def test_service_days_and_transitions(spark):  # E16, W2-W5
    rows = [(1, "HMIS", None, d(0), d(10), "a"), (1, "SHA", None, d(5), d(8), "b"),
            (1, "SHA", None, d(20), d(15), "c")]
    df = spark.createDataFrame(rows, "linkage_PID int, agency string, hmis_proj_type string, entry date, exit date, k string")
    df = spells.service_days(spells.impute_exit(df, tiebreak=["k"]))
    df = spells.transitions(df, tiebreak=["k"])
    got = {r.k: r for r in df.collect()}
    assert got["a"].h_servdays == 11 and got["c"].h_servdays is None and got["c"].h_time_qual == 1
    assert got["a"].h_tot_time == 10 and got["b"].h_agency_time == 3
    assert got["a"].h_agency_trans == "HMIS to SHA" and got["a"].h_within is True and got["a"].h_overlap is True
    assert got["b"].h_agency_trans == "SHA to SHA" and got["b"].h_t2next_prog is None
    assert got["c"].h_agency_trans == "SHA"


def test_modal_value(spark):  # A7
    df = spark.createDataFrame([(1, d(0)), (1, d(0)), (1, d(1)), (2, d(1)), (2, d(2)), (3, None), (3, None),
                                (3, d(5))], "p int, v date")
    ties = sorted((r.p, r.v) for r in ag.modal_value(df, "p", "v").collect() if r.v is not None)
    assert ties == [(1, d(0)), (2, d(1)), (2, d(2))]
    one = {r.p: r.v for r in ag.modal_value(df, "p", "v", keep_ties=False).collect()}
    assert one == {1: d(0), 2: d(1), 3: None}


def _merged(spark):
    hmis = spark.createDataFrame(
        [(1, 100, "1", "A", "B", None, 0, dt.date(1980, 1, 1), 1, 0, 0, 0, 1, 0, dt.date(2010, 1, 1), None,
          "Emergency Shelter", "Shelter A"),
         (2, 100, "2", "C", "D", None, 1, dt.date(2005, 1, 1), 0, 0, 1, 0, 0, 0, dt.date(2010, 1, 1),
          dt.date(2010, 3, 1), "Transitional Housing", "TH B")],
        "PersonalID int, HouseholdID int, RelationshipToHoH string, LastName string, FirstName string, "
        "MiddleName string, Gender int, DOB date, AmIndAKNative int, Asian int, BlackAfAmerican int, "
        "NativeHIOtherPacific int, White int, Ethnicity int, EntryDate date, ExitDate date, ProjectType string, "
        "ProjectName string")
    pha = spark.createDataFrame(
        [(7, "SHA", 55, "Y", "E", "F", None, "Female", dt.date(1980, 1, 1), 1, None, None, None, None,
          "White only", 0, "Disabled", dt.date(2011, 1, 1), dt.date(2012, 1, 1), "HCV", "T", "S", "V", "O", "P")],
        "pid int, agency_new string, hh_id_new int, relcode string, lname_new string, fname_new string, "
        "mname_new string, gender2 string, dob date, r_aian_new int, r_asian_new int, r_black_new int, "
        "r_nhpi_new int, r_white_new int, race_new string, r_hisp_new int, disability2 string, startdate date, "
        "enddate date, major_prog string, prog_type string, subsidy_type string, vouch_type_final string, "
        "operator_type string, portfolio_final string")
    links = spark.createDataFrame([("HMIS0_1", 10), ("HMIS0_2", 20), ("PHA0_7", 10)], "pid0 string, linkage_PID long")
    return agencies.merge_agencies(hmis, pha, links)


def test_merge_agencies(spark):  # E10
    m = {r.pid0: r for r in _merged(spark).collect()}
    assert m["HMIS0_1"].hh_id == "HMIS_100" and m["HMIS0_1"].gender == "Fem"
    assert m["HMIS0_1"].hmis_prog_cat == "HMIS,Emergency Shelter,Shelter A," and m["HMIS0_1"].ha_prog_cat is None
    assert m["PHA0_7"].hh_id == "SHA_55" and m["PHA0_7"].r_white == 1 and m["PHA0_7"].r_asian is None
    assert m["PHA0_7"].ha_prog_cat == "SHA,S,V,O,P" and m["PHA0_7"].linkage_PID == 10


def test_person_spell_frame(spark):  # E11, E12
    merged = _merged(spark)
    cl = {r.pid0: (r.h_cluster, r.h_cluster_ct) for r in agencies.household_clusters(merged).collect()}
    assert cl["HMIS0_1"] == cl["HMIS0_2"] == (1, 2)
    out = {r.pid0: r for r in agencies.person_spell_frame(merged).collect()}
    assert set(out) == {"HMIS0_1", "HMIS0_2", "PHA0_7"}
    # person 10: PHA birth date wins; open shelter spell, next entry 365 days away: entry + 90
    assert out["HMIS0_1"].h_dob == dt.date(1980, 1, 1)
    assert out["HMIS0_1"].h_exit == dt.date(2010, 4, 1)
    assert out["HMIS0_1"].h_agency_trans == "HMIS to SHA"
    assert out["HMIS0_2"].h_child == "yes" and out["HMIS0_2"].h_hh_type2 == "single parent household with children"


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_hot_person_forms_agree_with_plain_windows(spark, coalesce):  # sequence over ranges, furthest ends
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rnd = random.Random(11)
    rows = []
    for k in range(400):
        p = rnd.choice([1, 1, 1, 2, 3, None])
        a = rnd.randint(0, 40)
        rows.append((k, p, d(a), None if rnd.random() < 0.2 else d(a + rnd.randint(0, 12))))
    df = spark.createDataFrame(rows, "k int, p int, s date, e date")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        a = spells.next_values(df, "p", "s", [("e", True), ("k", False)], ["k", "e"]).select("k", "_n_k", "_n_e").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    w = Window.partitionBy("p").orderBy(F.col("s").asc_nulls_last(), F.col("e").asc_nulls_last(), "k")
    b = df.select("k", F.lead("k").over(w), F.lead("e").over(w))
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b.collect()), key=str)
    days = {}
    for _, p, s, e in rows:
        if e is not None:
            days.setdefault(p, set()).update(range(s.toordinal(), e.toordinal()))
    x = ag.covered_days(df, ["p"], "s", "e")
    assert all(r.covered_days == len(days.get(r.p, ())) for r in x.collect())


def test_hot_person_and_date_are_split(spark):  # 40,000 spells of one person on one day
    from pyspark.sql import functions as F
    n = 40_000
    df = spark.range(n).select(F.col("id").alias("k"), F.lit(1).alias("p"), F.lit("2012-01-01").cast("date").alias("s"),
                               F.date_add(F.lit("2012-01-02").cast("date"), (F.col("id") % 50).cast("int")).alias("e"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = spells.next_values(df, "p", "s", [("e", False), ("k", False)], ["k"], "_n_")
        got = out.agg(F.count("_n_k"), F.countDistinct("_n_k"), F.count_if(F.col("_n_k") == F.col("k"))).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tuple(got) == (n - 1, n - 1, 0)
    ends = ag.furthest_ends(df, ["p"], "s", "e")
    assert ends.count() == 1                                    # what the person's window sees
    assert ag.covered_days(df, ["p"], "s", "e").agg(F.max("covered_days"), F.min("covered_days")).first() == (50, 50)


def test_one_scan(spark, tmp_path):
    rows = [(1, "HMIS", "x", d(0), d(10), "a"), (1, "SHA", None, d(5), d(8), "b")]
    spark.createDataFrame(rows, "linkage_PID int, agency string, hmis_proj_type string, entry date, exit date, k string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = spells.transitions(spells.service_days(spells.impute_exit(df, tiebreak=["k"])), tiebreak=["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2                          # the written sequence, and the heads of its ranges


def test_named_columns_go_through_the_steps_alone(spark, monkeypatch):  # F3, F8 of round 3
    schema = ("row_key string, pid0 string, hh_id string, relcode string, lname string, r_aian int, r_asian int, dob date, "
              "entry date, exit date, agency string, disability string, hmis_proj_type string, linkage_PID int")
    d = dt.date
    base = ("HMIS0_1", "h1", "2", "x", None, 1, d(1980, 1, 1), d(2010, 1, 1), d(2010, 2, 1), "HMIS", None, None, 1)
    rows_ = [("a", *base), ("a", *base), ("a", *base[:4], 1, None, *base[6:]), ("b", *base[:1], "h2", *base[2:])]
    merged = spark.createDataFrame(rows_, schema)
    written = []
    for module in (agencies, agencies.spells):
        real = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, tag, real=real: written.append((tag, set(df.columns))) or real(df, tag))
    names = ["row_key", "h_age", "h_hh_ct", "h_exit", "h_tot_time", "h_agency_trans"]
    whole = agencies.person_spell_frame(merged, min_entry="1996-01-01", tiebreak=["row_key"]).select(names).collect()
    written.clear()
    few = agencies.person_spell_frame(merged, min_entry="1996-01-01", tiebreak=["row_key"], columns=[])
    assert sorted(map(str, few.select(names).collect())) == sorted(map(str, whole)) and len(whole) == 3
    assert len(written) == 4 and not any({"lname", "r_aian", "pid0"} & columns for _, columns in written)
    written.clear()
    labelled = agencies.household_clusters(merged, columns=["row_key"])
    assert written[0] == ("merged", {"row_key", "hh_id", "linkage_PID"}) and labelled.count() == 4


def test_sequence_moves_rows_once(spark):  # F2 of round 4
    import random

    from pyspark.sql import Window
    rnd = random.Random(5)
    rows_ = [(rnd.choice([1, 1, 2, None]), d(rnd.randint(0, 3)), rnd.choice("ab"), rnd.choice([None, 1]), rnd.choice([None, 1]),
              rnd.choice([0.5, float("nan"), None])) for _ in range(300)]
    df = spark.createDataFrame(rows_, "p int, s date, k string, x int, y int, z double")
    out = spells.next_values(df, "p", "s", [("k", False)], ["s", "k"], distinct=True)
    assert "hashpartitioning(_range" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, out.select(df.columns).collect())) == sorted(map(str, df.distinct().collect()))
    w = Window.partitionBy("p").orderBy("s", "k")
    want = df.distinct().select("p", "s", "k", F.lead("s").over(w), F.lead("k").over(w)).collect()
    got = out.select("p", "s", "k", "_n_s", "_n_k").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, want)))
    # what only tells rows apart stays where there is another row of the same order, whatever the ranges
    lone = spark.range(50).selectExpr("1 as p", "date '2010-01-01' as s", "cast(id div 2 * int(id < 20) + id * int(id >= 20) as string) as k", "id as x")
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            kept = {r.k: r.x for r in spells.next_values(lone, "p", "s", [("k", False)], ["s"], apart=["x"]).collect() if r.x is None or int(r.x) < 20}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert all(kept[str(k)] is not None for k in range(10))
        assert sum(v is None for v in kept.values()) >= 30 - 2 * int(n)


def test_written_steps_leave_no_shuffle_files(spark):  # F2 of round 4
    import time

    from kinlink.session import materialize
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = lambda: {n for n in blocks.getAllBlocks().mkString(" ").split() if n.startswith("shuffle_") and n.endswith(".data")}
    before = found()
    table, _ = materialize(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "t")
    for _ in range(50):
        if not found() - before:
            break
        time.sleep(0.1)
    assert not found() - before
    assert table.count() == 7


def test_columns_not_asked_for_do_not_meet_the_links(spark):  # F2 of round 4
    names = ["row_key", *agencies.SPELL_COLUMNS]
    hmis = spark.createDataFrame(
        [("a", 1, "F", 1, None), ("a", 1, "F", None, 1), ("a", 1, "F", None, 1), ("b", 1, "G", 1, 1)],
        "row_key string, PersonalID int, FirstName string, AmIndAKNative int, Asian int")
    for c in ("HouseholdID", "RelationshipToHoH", "LastName", "MiddleName", "ProjectType", "ProjectName"):
        hmis = hmis.withColumn(c, F.lit(None).cast("string"))
    for c in ("Gender", "BlackAfAmerican", "NativeHIOtherPacific", "White", "Ethnicity"):
        hmis = hmis.withColumn(c, F.lit(1))
    hmis = hmis.withColumns({"DOB": F.lit("1980-01-01").cast("date"), "EntryDate": F.lit("2010-01-01").cast("date"), "ExitDate": F.lit("2010-02-01").cast("date")})
    pha = spark.createDataFrame([], "row_key string, pid int, agency_new string, hh_id_new int, relcode string, lname_new string, fname_new string, "
        "mname_new string, gender2 string, dob date, r_aian_new int, r_asian_new int, r_black_new int, r_nhpi_new int, r_white_new int, "
        "race_new string, r_hisp_new int, disability2 string, startdate date, enddate date, major_prog string, prog_type string, "
        "subsidy_type string, vouch_type_final string, operator_type string, portfolio_final string")
    links = spark.createDataFrame([("HMIS0_1", 10)], "pid0 string, linkage_PID long")
    few = agencies.merge_agencies(hmis, pha, links, keep=["row_key"], columns=names)
    assert set(few.columns) == {*names, "pid0", *agencies.OTHERS} and few.count() == 4
    frames = [agencies.person_spell_frame(m, tiebreak=["row_key"], columns=[])
              for m in (few, agencies.merge_agencies(hmis, pha, links, keep=["row_key"]))]
    x, y = (sorted(map(str, f.select("row_key", "linkage_PID", "h_hh_ct", "h_exit", "h_agency_trans", "h_tot_time").collect())) for f in frames)
    assert x == y and len(x) == 3
