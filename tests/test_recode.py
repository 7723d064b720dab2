"""J1 (fixture F15), P9-P20 column rules."""

import datetime as dt

from pyspark.sql import functions as F

from kinlink.functions import recode as rc
from kinlink.functions.nulls import if_else3, r_paste
from kinlink.operators import joins


def test_merge_destination(spark):  # F15
    df = spark.createDataFrame([(1,), (2,), (3,)], "numeric int")
    out = joins.merge_destination(df, "numeric").orderBy("DestinationNumeric").collect()
    assert "numeric" not in out[0].asDict() and "Standard" not in out[0].asDict()
    assert [r.Subsidy for r in out] == [False, False, True]
    assert [r.DestinationGroup for r in out] == ["Temporary", "Temporary", "Permanent"]


def test_name_exclusion(spark):  # P9
    df = spark.createDataFrame([("Ann", "Lee"), ("J.", "Smith"), ("Refused", "X"), ("Bob2", "Ray"),
                                (None, "Ray"), ("Mary", "Client Unknown"), ("Al", "O.B")], "f string, l string")
    assert [(r.f, r.l) for r in rc.exclude_names(df, ["f", "l"]).collect()] == [("Ann", "Lee"), ("Al", "O.B")]
    nums = spark.createDataFrame([(1, "Lee")], "f int, l string")
    assert rc.exclude_names(nums, ["f", "l"]).count() == 0


def test_refused_names(spark):  # P10
    df = spark.createDataFrame([("REFUSED", "A"), (None, "B"), ("C", "ANONYMOUS X"), ("D", "E")], "l string, f string")
    assert [r.f for r in df.filter(rc.refused_name_keep(["l", "f"])).collect()] == ["B", "E"]


def test_ssn_rules(spark):  # P11-P14
    df = spark.createDataFrame([(None,), (11111111.0,), (123456789.0,), (1234567.0,), (1111111111.0,),
                                (222222222.0,), (0.0,)], "ssn double")
    out = df.select(rc.clean_ssn(F.col("ssn")).alias("c")).select(
        "c", rc.stringify_ssn(F.col("c")).alias("s"),
        rc.ssn_repeated_digit(F.col("c"), rc.ssn_quality_pha(F.col("c"))).alias("dq")).collect()
    assert [r.s for r in out] == [None, None, "123456789", "1234567", "1111111111", "222222222", "0"]
    # null SSN -> 3; ten ones is not a repeated nine-digit value; 1234567 keeps 7 digits
    assert [r.dq for r in out] == [3, 3, 1, 2, 1, 3, 3]
    u = spark.createDataFrame([("123456789", 1), ("123456789", 2), ("1234567", 1)], "s string, dq int")
    assert [r.x for r in u.select(rc.usable_ssn(F.col("s"), F.col("dq")).alias("x")).collect()] == \
        ["123456789", None, None]


def test_if_else3_and_paste(spark):  # 1.4 null rules
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    assert [r.x for r in df.select(if_else3(F.col("c"), "a", "b").alias("x")).collect()] == ["a", "b", None]
    d2 = spark.createDataFrame([("x", None)], "a string, b string")
    assert d2.select(r_paste(F.col("a"), F.col("b"), sep="_").alias("p")).first().p == "x_NA"


def test_gender_race_ids(spark):  # P17-P19, W6
    df = spark.createDataFrame([(0, "Female", 1, "Asian only"), (4, "Male", None, "Asian only"),
                                (9, "Other", None, "White only"), (None, None, 0, None)],
                               "g int, g2 string, flag int, race string")
    out = df.select(rc.gender_hmis(F.col("g")).alias("a"), rc.gender_pha(F.col("g2")).alias("b"),
                    rc.gender_prelink(F.col("g2")).alias("c"),
                    rc.race_flag(F.col("flag"), F.col("race"), "Asian only").alias("r"),
                    rc.prefixed_id("HMIS0_", F.col("g")).alias("p"),
                    rc.seq_id("pid2_", F.lit(1234567)).alias("s")).collect()
    assert [r.a for r in out] == ["Fem", "GNC", None, None]
    assert [r.b for r in out] == ["Fem", "Mal", None, None]
    assert [r.c for r in out] == [1, 0, None, None]
    # FALSE | NA is NA in R, so an unknown category keeps the flag unknown
    assert [r.r for r in out] == [1, 1, None, None]
    assert [r.p for r in out] == ["HMIS0_0", "HMIS0_4", "HMIS0_9", "HMIS0_NA"]
    assert out[0].s == "pid2_1234567"


def test_date_parts(spark):  # P15
    df = spark.createDataFrame([(dt.date(1990, 2, 1),)], "dob date")
    r = rc.date_parts(df, "dob").first()
    assert (r.dob_y, r.dob_m, r.dob_d) == (1990, 2, 1)
