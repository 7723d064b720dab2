"""E1-E9, R1-R3, D4-D10 (fixtures F3-F10)."""

import datetime as dt
import json
import os
import random

import numpy as np
import pandas as pd
import pytest

from conftest import rows, write_csv
from kinlink.functions import codes
from kinlink.operators import reshape
from kinlink.plans import hmis

STAGE_META = {"duplicate_check_columns": ["id", "stage", "value"], "categorical_var": ["value"],
              "collection_stage_column": "stage", "entry_stage_val": 0, "exit_stage_val": 1,
              "update_stage_val": 2, "annual_assessment_stage_val": 5, "post_exit_stage_val": 6,
              "person_enrollment_ID": "id"}


def test_read_entry_exit(spark, tmp_path):  # F3
    f = write_csv(str(tmp_path), "s.csv", pd.DataFrame({"id": [11, 11, 12], "stage": [0, 1, 0],
                                                        "value": [0, 1, 0]}))
    meta = tmp_path / "m.json"
    meta.write_text(json.dumps({"name": "test", **STAGE_META}))
    df = hmis.read_entry_exit_table(spark, str(meta), file_spec={2011: f})
    assert sorted(df.columns) == ["id", "value_entry", "value_exit"]
    assert rows(df, key=["id"]) == [{"id": "11", "value_entry": 0, "value_exit": 1},
                                    {"id": "12", "value_entry": 0, "value_exit": None}]
    bad = {k: STAGE_META[k] for k in ("duplicate_check_columns", "categorical_var")}
    with pytest.raises(ValueError):
        hmis.read_entry_exit_table(spark, bad, file_spec={2011: f})


def test_split_rows_multiplies_and_null_keys(spark):  # R1 definition
    df = spark.createDataFrame([(1, 0, "a"), (1, 0, "b"), (1, 1, "c"), (None, 0, "n0"), (None, 1, "n1"),
                                (2, 1, "d"), (3, None, "z")], "k int, s int, v string")
    wide = reshape.split_rows_to_columns(df, "s", {0: "_entry", 1: "_exit"}, "k")
    got = sorted((r.k if r.k is not None else -1, r.v_entry, r.v_exit) for r in wide.collect())
    assert got == [(-1, "n0", "n1"), (1, "a", "c"), (1, "b", "c"), (2, None, "d")]
    with pytest.raises(TypeError):
        reshape.split_rows_to_columns(df, ["s"], {0: "_e"}, "k")


def test_split_rows_fast_path_agrees(spark):  # R1 fast path == slow path when unique
    random.seed(3)
    data = {(random.randint(0, 40), random.choice([0, 1, 2])) for _ in range(120)}
    recs = [(k, s, random.choice([None, 1, 2, 3])) for k, s in data]
    df = spark.createDataFrame(recs, "k int, s int, v int")
    slow = reshape.split_rows_to_columns(df, "s", {0: "_entry", 1: "_exit"}, "k")
    fast = reshape.split_rows_to_columns(df, "s", {0: "_entry", 1: "_exit"}, "k", unique=True)
    assert sorted(map(tuple, slow.select("k", "v_entry", "v_exit").collect()), key=str) == \
        sorted(map(tuple, fast.select("k", "v_entry", "v_exit").collect()), key=str)


ENROLL_META = {"person_enrollment_ID": "id", "person_ID": "id", "program_ID": "id",
               "groupID_column": "id", "duplicate_check_columns": ["id", "time1", "categ1"],
               "columns_to_drop": ["drop1"], "categorical_var": ["categ1"], "time_var": ["time1"],
               "entry_date": "time1"}


def test_get_enrollment(spark, tmp_path):  # F4
    f = write_csv(str(tmp_path), "e.csv", pd.DataFrame({
        "id": [1, 1, 2, 2], "time1": ["2001-01-13", "2004-05-21", "2003-06-10", "2003-06-10"],
        "drop1": [2, 3, 4, 5], "ig_dedup1": [5, 6, 7, 8], "categ1": [0, 8, 0, 0]}))
    g = hmis.get_enrollment(spark, groups=True, file_spec={"2011": f}, metadata=ENROLL_META)
    assert rows(g, ["id", "ig_dedup1", "categ1"], key=["ig_dedup1"]) == [
        {"id": "1", "ig_dedup1": "5", "categ1": 0}, {"id": "1", "ig_dedup1": "6", "categ1": None}]
    a = hmis.get_enrollment(spark, groups=False, file_spec={"2011": f}, metadata=ENROLL_META, sort=True)
    assert [r.ig_dedup1 for r in a.collect()][:2] in (["5", "6"], ["6", "5"])
    assert a.count() == 3


def test_get_exit(spark, tmp_path):  # F5, J1
    f = write_csv(str(tmp_path), "x.csv", pd.DataFrame({"id": [11, 12, 13], "dest": [2, 25, 26]}))
    meta = {"person_enrollment_ID": "id", "destination_column": "dest",
            "duplicate_check_columns": ["id"], "columns_to_drop": []}
    df = hmis.get_exit(spark, file_spec={"2011": f}, metadata=meta)
    assert "dest" not in df.columns
    got = rows(df, key=["id"])
    assert [(r["DestinationGroup"], r["DestinationSuccess"], r["Subsidy"]) for r in got] == [
        ("Temporary", "Other Exit", False), ("Permanent", "Successful Exit", False),
        ("Permanent", "Successful Exit", True)]
    # every code of the list maps to its own row
    allc = write_csv(str(tmp_path), "all.csv", pd.DataFrame({"id": range(31),
                                                             "dest": [c for c, *_ in codes.DESTINATIONS]}))
    out = hmis.get_exit(spark, file_spec={"x": allc}, metadata={**meta, "categorical_var": []})
    assert out.filter("DestinationNumeric IS NULL").count() == 0


CLIENT_META = {"person_ID": "id", "duplicate_check_columns": ["id", "dob_col", "first_name"],
               "columns_to_drop": [], "categorical_var": ["bool_col", "numeric"],
               "time_var": ["dob_col", "time_col"], "boolean": ["bool_col"],
               "numeric_code": ["numeric"], "dob_column": "dob_col", "name_columns": ["first_name"]}


def _client_files(tmp_path):
    f1 = write_csv(str(tmp_path / "a"), "c.csv", pd.DataFrame({
        "id": [11, 12, 13, 15, 16, 17], "first_name": ["AAA", "BBB", "CCC", "EEE", "FFF", "noname"],
        "dob_col": ["1990-01-13", "2012-05-21", "1850-06-14", "1965-11-22", "1948-09-03", "2012-03-18"],
        "time_col": ["1996-01-13", "2014-05-21", "1950-06-14", "1985-11-22", "1978-09-03", "2014-03-18"],
        "bool_col": [1, 99, 1, 8, 0, 1], "numeric": [99, 3, 6, 0, 8, np.nan]}))
    f2 = write_csv(str(tmp_path / "b"), "c.csv", pd.DataFrame({
        "id": [11, 12, 13, 14, 15, 16, 17, 18],
        "first_name": ["AAA", "BBB", "CCC", "DDD", "EEE", "FFF", "noname", "HHH"],
        "dob_col": ["1990-01-15", "2012-05-21", "1850-06-14", "1975-12-08", "1967-11-22", None,
                    "2010-03-18", "2014-04-30"],
        "time_col": ["1996-01-15", "2014-05-21", "1950-06-14", "1995-12-08", "1987-11-22", None,
                     "2012-03-18", "2015-04-30"],
        "bool_col": [0, 0, 1, 0, 8, 0, np.nan, 1], "numeric": [5, 3, 7, 1, 0, 8, 6, 0]}))
    return {"2011": f1, "2012": f2}


def _d(s):
    return None if s is None else dt.datetime.strptime(s, "%Y-%m-%d")


F6_EXPECTED = [
    (11, "1990-01-13", "1996-01-14", 1, 5), (11, "1990-01-15", "1996-01-14", 1, 5),
    (12, "2012-05-21", "2014-05-21", 0, 3), (13, "1850-06-14", "1950-06-14", 1, None),
    (14, "1975-12-08", "1995-12-08", 0, 1), (15, "1965-11-22", None, None, 0),
    (15, "1967-11-22", None, None, 0), (16, "1948-09-03", "1978-09-03", 0, None),
    (16, None, "1978-09-03", 0, None), (17, "2010-03-18", None, 1, 6),
    (17, "2012-03-18", None, 1, 6), (18, "2014-04-30", "2015-04-30", 1, 0)]


@pytest.mark.parametrize("name_exclusion", [False, True])
def test_get_client(spark, tmp_path, name_exclusion):  # F6
    df = hmis.get_client(spark, file_spec=_client_files(tmp_path), metadata=CLIENT_META,
                         name_exclusion=name_exclusion)
    got = [(int(r.id), r.dob_col, r.time_col, r.bool_col, r.numeric) for r in df.collect()]
    exp = [(i, _d(a), _d(b), c, n) for i, a, b, c, n in F6_EXPECTED
           if not (name_exclusion and i == 17)]
    key = lambda t: (t[0], t[1] is None, t[1] or dt.datetime.min)
    assert sorted(got, key=key) == sorted(exp, key=key)


def test_get_client_requires_person_id(spark, tmp_path):
    meta = {k: v for k, v in CLIENT_META.items() if k != "person_ID"}
    with pytest.raises(ValueError):
        hmis.get_client(spark, file_spec=_client_files(tmp_path), metadata=meta)


DIS_META = {"person_enrollment_ID": "pid", "duplicate_check_columns": ["pid", "stage", "type"],
            "categorical_var": ["response"], "collection_stage_column": "stage",
            "entry_stage_val": 10, "exit_stage_val": 20, "update_stage_val": 30,
            "annual_assessment_stage_val": 40, "post_exit_stage_val": 50,
            "type_column": "type", "response_column": "response"}


@pytest.mark.parametrize("one_row", [False, True])
def test_get_disabilities(spark, tmp_path, one_row):  # F7
    f = write_csv(str(tmp_path), "d.csv", pd.DataFrame({
        "pid": [11, 11, 11, 11, 12, 12, 12, 12], "stage": [10, 10, 20, 20, 10, 10, 20, 20],
        "type": [5, 6, 5, 6, 5, 6, 5, 6], "response": [0, 1, 0, 1, 99, 0, 0, 1]}))
    df = hmis.get_disabilities(spark, file_spec={"x": f}, metadata=DIS_META, one_row=one_row)
    got = rows(df, ["pid", "Physical_entry", "Physical_exit", "Developmental_entry", "Developmental_exit"],
               key=["pid"])
    assert got == [
        {"pid": "11", "Physical_entry": 0, "Physical_exit": 0, "Developmental_entry": 1, "Developmental_exit": 1},
        {"pid": "12", "Physical_entry": None, "Physical_exit": 0, "Developmental_entry": 0, "Developmental_exit": 1}]


def test_disabilities_one_sided(spark, tmp_path):  # R3 needs both stages; one_row keeps such rows
    f = write_csv(str(tmp_path), "d.csv", pd.DataFrame({
        "pid": [11, 11, 13], "stage": [10, 20, 10], "type": [5, 5, 5], "response": [1, 0, 1]}))
    assert hmis.get_disabilities(spark, file_spec={"x": f}, metadata=DIS_META).count() == 1
    assert hmis.get_disabilities(spark, file_spec={"x": f}, metadata=DIS_META, one_row=True).count() == 2


def test_disabilities_several_responses(spark, tmp_path):  # R1: rows multiply
    f = write_csv(str(tmp_path), "d.csv", pd.DataFrame({
        "pid": [11, 11, 11], "stage": ["10.0", "10", "20"], "type": [5, 5, 5], "response": [0, 1, 1]}))
    meta = {**DIS_META, "duplicate_check_columns": ["pid", "stage", "type", "response"]}
    got = hmis.get_disabilities(spark, file_spec={"x": f}, metadata=meta).collect()
    assert sorted((r.Physical_entry, r.Physical_exit) for r in got) == [(0, 1), (1, 1)]


def test_default_income_keeps_every_enrollment_and_takes_numbers(spark, tmp_path):
    from kinlink.sources import hmis_config
    cols = [c for c in hmis_config.INCOME["duplicate_check_columns"] if c not in ("ProjectEntryID", "DataCollectionStage")]
    base = {c: "1" for c in cols}
    recs = [{**base, "ProjectEntryID": e, "DataCollectionStage": s, "TotalMonthlyIncome": t}
            for e, s, t in (("2", "1", "900"), ("2", "1", "1200"), ("3", "1", "900"), ("3.0", "1", "1200"), ("2", "3", "5.5"))]
    f = write_csv(str(tmp_path), "IncomeBenefits.csv", pd.DataFrame(recs))
    got = {r.ProjectEntryID: r for r in hmis.get_income(spark, file_spec={"x": f}).collect()}
    assert {k: (r.TotalMonthlyIncome_entry, r.TotalMonthlyIncome_exit) for k, r in got.items()} == {"2": (1200.0, 5.5), "3": (1200.0, None)}


def test_codes_that_are_no_whole_numbers_stay(spark, tmp_path):  # P3 nulls listed codes only
    f = write_csv(str(tmp_path), "t.csv", pd.DataFrame({"id": [1, 2, 3], "c": ["a", "8", "1"], "d": ["1.5", "8", "2"], "e": ["1.0", "8.0", "#NA"]}))
    df = hmis.read_table(spark, {"x": f}, categorical_var=["c", "d", "e"], categorical_unknown=[8], dedup_rows=False).orderBy("id")
    assert [tuple(r)[1:] for r in df.collect()] == [("a", 1.5, 1), (None, None, None), ("1", 2.0, None)]


def test_line_break_in_quotes(spark, tmp_path):
    f = write_csv(str(tmp_path), "t.csv", pd.DataFrame({"id": [1, 2], "name": ["one\ntwo", "x"]}))
    df = hmis.read_table(spark, {"x": f}, dedup_rows=False, multi_line=True)
    assert sorted((r.id, r.name) for r in df.collect()) == [("1", "one\ntwo"), ("2", "x")]


def test_misspelt_option_is_an_error(spark, tmp_path):
    f = write_csv(str(tmp_path), "t.csv", pd.DataFrame({"id": [1]}))
    with pytest.raises(TypeError):
        hmis.read_table(spark, {"x": f}, dedup_row=False)


def test_get_income(spark, tmp_path):  # F8
    f = write_csv(str(tmp_path), "i.csv", pd.DataFrame({
        "pid": [11, 11, 11, 12, 12, 12, 12], "stage": [0, 0, 1, 0, 0, 1, 1],
        "income": [1, 1, 1, 0, 1, np.nan, 1], "incomeAmount": [5, 8, 12, 0, 6, 0, 3]}))
    meta = {"person_enrollment_ID": "pid", "categorical_var": ["income"],
            "collection_stage_column": "stage", "entry_stage_val": 0, "exit_stage_val": 1,
            "update_stage_val": 2, "annual_assessment_stage_val": 5, "post_exit_stage_val": 6,
            "columns_to_take_max": ["income", "incomeAmount"],
            "duplicate_check_columns": ["pid", "stage", "income", "incomeAmount"]}
    df = hmis.get_income(spark, file_spec={"x": f}, metadata=meta)
    got = [(r.pid, r.income_entry, r.income_exit, float(r.incomeAmount_entry), float(r.incomeAmount_exit))
           for r in df.orderBy("pid").collect()]
    assert got == [("11", 1, 1, 8.0, 12.0), ("12", 1, 1, 6.0, 3.0)]
    with pytest.raises(ValueError):
        hmis.get_income(spark, file_spec={"x": f},
                        metadata={k: v for k, v in meta.items() if k != "columns_to_take_max"})


def test_get_project(spark, tmp_path):  # F9
    f = write_csv(str(tmp_path), "p.csv", pd.DataFrame({"pid": [3, 4], "name": ["shelter1", "rrh2"],
                                                        "ProjectType": [1, 13]}))
    meta = {"program_ID": "pid", "duplicate_check_columns": ["pid"], "project_type_column": "ProjectType"}
    got = rows(hmis.get_project(spark, file_spec={"x": f}, metadata=meta), key=["pid"])
    assert [(r["ProjectNumeric"], r["ProjectType"]) for r in got] == [
        (1, "Emergency Shelter"), (13, "PH - Rapid Re-Housing")]
    assert "ProjectTypeNum" not in got[0]


def _f10(tmp_path):
    d = str(tmp_path / "2011")
    write_csv(d, "Enrollment.csv", pd.DataFrame({
        "personID": [1, 2, 3, 4], "person_enrollID": [10, 20, 30, 40], "programID": [100, 200, 200, 100],
        "groupID": [1000, 2000, 3000, 4000],
        "entrydate": ["2011-01-13", "2011-06-10", "2011-12-05", "2011-09-10"]}))
    write_csv(d, "Exit.csv", pd.DataFrame({"ppid": [10, 20, 30, 40], "dest_num": [12, 27, 20, 10],
                                           "exitdate": ["2011-08-01", "2011-12-21", "2011-12-27", "2011-11-30"]}))
    write_csv(d, "Client.csv", pd.DataFrame({
        "pid": [1, 1, 2, 2, 3, 3, 4, 4],
        "dob": ["1990-03-13", "2012-04-16", "1955-08-21", "1855-08-21", "2001-02-16", "2003-02-16",
                "1983-04-04", "1983-04-06"],
        "gender": [0, 0, 1, 1, 1, 1, 0, 0], "veteran": [0, 0, 1, 1, 0, 0, 0, 0],
        "first_name": ["AAA", "AAA", "noname", "noname", "CCC", "CCC", "DDD", "DDD"]}))
    write_csv(d, "Disabilities.csv", pd.DataFrame({
        "person_enrollID": [10, 10, 20, 20, 30, 30, 40, 40], "stage": [0, 1] * 4, "type": [5] * 8,
        "response": [0, 0, 1, 1, 0, 0, 0, 1]}))
    write_csv(d, "EmploymentEducation.csv", pd.DataFrame({
        "ppid": [10, 10, 20, 20, 30, 30, 40, 40], "stage": [0, 1] * 4, "employed": [0, 0, 0, 1, 1, 1, 0, 1]}))
    write_csv(d, "HealthAndDV.csv", pd.DataFrame({
        "ppid": [10, 10, 20, 20, 30, 30, 40, 40], "stage": [0, 1] * 4,
        "health_status": [0, 0, 0, 1, 1, 1, 0, 1]}))
    write_csv(d, "IncomeBenefits.csv", pd.DataFrame({
        "ppid": [10, 10, 20, 20, 30, 30, 40, 40], "stage": [0, 1] * 4,
        "income": [0, 0, 0, 1000, 500, 400, 0, 300]}))
    write_csv(d, "Project.csv", pd.DataFrame({"pr_id": [100, 200], "type": [1, 2]}))
    stage = {"collection_stage_column": "stage", "entry_stage_val": 0, "exit_stage_val": 1,
             "update_stage_val": 2, "annual_assessment_stage_val": 5, "post_exit_stage_val": 6,
             "columns_to_drop": []}
    metas = {
        "enrollment": {"person_enrollment_ID": "person_enrollID", "person_ID": "personID",
                       "program_ID": "programID", "groupID_column": "groupID",
                       "duplicate_check_columns": ["personID", "person_enrollID", "programID", "groupID"],
                       "columns_to_drop": [], "time_var": ["entrydate"], "entry_date": "entrydate"},
        "exit": {"person_enrollment_ID": "ppid", "destination_column": "dest_num",
                 "duplicate_check_columns": ["ppid"], "columns_to_drop": [], "time_var": ["exitdate"]},
        "client": {"person_ID": "pid", "dob_column": "dob", "time_var": ["dob"],
                   "categorical_var": ["gender", "veteran"], "boolean": ["veteran"],
                   "numeric_code": ["gender"], "duplicate_check_columns": ["pid", "dob"],
                   "name_columns": ["first_name"]},
        "disabilities": {"person_enrollment_ID": "person_enrollID", "categorical_var": ["response"],
                         "type_column": "type", "response_column": "response",
                         "duplicate_check_columns": ["person_enrollID", "stage", "type"], **stage},
        "employment_education": {"person_enrollment_ID": "ppid", "categorical_var": ["employed"],
                                 "duplicate_check_columns": ["ppid", "stage"], **stage},
        "health_dv": {"person_enrollment_ID": "ppid", "categorical_var": ["health_status"],
                      "duplicate_check_columns": ["ppid", "stage"], **stage},
        "income": {"person_enrollment_ID": "ppid", "categorical_var": ["income"],
                   "columns_to_take_max": ["income"], "duplicate_check_columns": ["ppid", "stage"], **stage},
        "project": {"program_ID": "pr_id", "project_type_column": "type",
                    "duplicate_check_columns": ["pr_id"], "columns_to_drop": []},
    }
    files = {}
    for k, v in metas.items():
        p = tmp_path / f"{k}.json"
        p.write_text(json.dumps({"name": k, **v}))
        files[k] = str(p)
    return files


F10 = {
    "personID": ["1", "2", "3", "4"], "first_name": ["AAA", "noname", "CCC", "DDD"],
    "person_enrollID": ["10", "20", "30", "40"], "programID": ["100", "200", "200", "100"],
    "groupID": ["1000", "2000", "3000", "4000"],
    "entrydate": [dt.datetime(2011, 1, 13), dt.datetime(2011, 6, 10), dt.datetime(2011, 12, 5),
                  dt.datetime(2011, 9, 10)],
    "DestinationNumeric": [12, 27, 20, 10],
    "DestinationGroup": ["Temporary", "Temporary", "Permanent", "Permanent"],
    "DestinationSuccess": ["Other Exit", "Other Exit", "Successful Exit", "Successful Exit"],
    "exitdate": [dt.datetime(2011, 8, 1), dt.datetime(2011, 12, 21), dt.datetime(2011, 12, 27),
                 dt.datetime(2011, 11, 30)],
    "Subsidy": [False, False, True, False],
    "dob": [dt.datetime(1990, 3, 13), dt.datetime(1955, 8, 21), None, dt.datetime(1983, 4, 5)],
    "gender": [0, 1, 1, 0], "veteran": [0, 1, 0, 0],
    "Physical_entry": [0, 1, 0, 0], "Physical_exit": [0, 1, 0, 1],
    "employed_entry": [0, 0, 1, 0], "employed_exit": [0, 1, 1, 1],
    "health_status_entry": [0, 0, 1, 0], "health_status_exit": [0, 1, 1, 1],
    "income_entry": [0, 0, 500, 0], "income_exit": [0, 1000, 400, 300],
    "ProjectNumeric": [1, 2, 2, 1],
    "ProjectType": ["Emergency Shelter", "Transitional Housing", "Transitional Housing", "Emergency Shelter"],
}


@pytest.mark.parametrize("name_exclusion", [False, True])
def test_merge_tables(spark, tmp_path, name_exclusion):  # F10
    from pyspark.sql import Observation
    metas = _f10(tmp_path)
    obs = Observation("dob")
    counts = {}
    df = hmis.merge_tables(spark, meta_files=metas, data_dir=str(tmp_path), paths=["2011"], groups=False,
                           name_exclusion=name_exclusion, observation=obs, row_counts=counts)
    got = rows(df, key=["personID"])
    exp = [{k: v[i] for k, v in F10.items()} for i in range(4)]
    if name_exclusion:
        exp = [e for e in exp if e["first_name"] != "noname"]
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        assert {k: g[k] for k in e} == e
        # declared schema: disability types absent from the data are all null
        assert g["Developmental_entry"] is None
    for gone in ("pid", "ppid", "dest_num", "pr_id", "type"):
        assert gone not in df.columns
    assert counts["enrollment"].get["n_rows"] == 4 and counts["income"].get["n_rows"] == 4
    assert counts["client"].get["n_rows"] == (3 if name_exclusion else 4)
    # person 2 (1855) is screened out by name before the birth-date check
    assert obs.get["n_bad_dob"] == (1 if name_exclusion else 2)


def test_mapping_files(spark, tmp_path):  # F15, and JSON lists
    import json
    m = write_csv(str(tmp_path), "map.csv", pd.DataFrame({
        "Standard": ["New Standards"] * 3 + ["Old Standards"], "DestinationNumeric": [1, 2, 3, 4],
        "DestinationDescription": list("abcd"), "DestinationGroup": list("efgh"), "DestinationSuccess": list("ijkl"),
        "Subsidy": ["No", "Yes", "No", "No"]}))
    x = write_csv(str(tmp_path), "x.csv", pd.DataFrame({"id": [1, 2, 3, 4], "dest": [1, 2, 3, 4]}))
    meta = {"person_enrollment_ID": "id", "destination_column": "dest", "duplicate_check_columns": ["id", "dest"]}
    got = rows(hmis.get_exit(spark, file_spec={"x": x}, metadata=meta, destination_map=m), key=["id"])
    assert [(r["DestinationNumeric"], r["DestinationDescription"], r["Subsidy"]) for r in got] == [
        (1, "a", False), (2, "b", True), (3, "c", False), (None, None, None)]
    assert "dest" not in got[0] and "Standard" not in got[0]
    (tmp_path / "p.json").write_text(json.dumps({"name": "types", "1": "One", "2": "Two"}))
    p = write_csv(str(tmp_path), "p.csv", pd.DataFrame({"id": [1, 2], "t": ["2.0", "7"]}))
    got = hmis.get_project(spark, file_spec={"x": p}, project_type_file=str(tmp_path / "p.json"),
                           metadata={"program_ID": "id", "project_type_column": "t", "duplicate_check_columns": ["id"]})
    assert [(r.ProjectNumeric, r.ProjectType) for r in got.orderBy("id").collect()] == [(2, "Two"), (None, None)]
    (tmp_path / "d.json").write_text(json.dumps({"5": "Walking"}))
    f = write_csv(str(tmp_path), "d.csv", pd.DataFrame({"pid": [1, 1], "stage": [10, 20], "type": [5, 5], "response": [0, 1]}))
    got = hmis.get_disabilities(spark, file_spec={"x": f}, metadata=DIS_META, disability_type_file=str(tmp_path / "d.json")).first()
    assert (got.Walking_entry, got.Walking_exit) == (0, 1)


def test_unlisted_stages_are_counted(spark, tmp_path):  # P6
    from pyspark.sql import Observation
    f = write_csv(str(tmp_path), "s.csv", pd.DataFrame({"id": [1, 1, 2, 2, 3], "stage": ["0", "1.0", "2", "9", "x"], "value": list("abcde")}))
    meta = {"person_enrollment_ID": "id", "collection_stage_column": "stage", "entry_stage_val": 0, "exit_stage_val": 1,
            "update_stage_val": 2, "annual_assessment_stage_val": 5, "post_exit_stage_val": 6, "duplicate_check_columns": ["id", "stage"]}
    seen = Observation("stages")
    got = hmis.read_entry_exit_table(spark, meta, file_spec={"x": f}, observation=seen).collect()
    assert [(r.id, r.value_entry, r.value_exit) for r in got] == [("1", "a", "b")] and seen.get["n_unlisted"] == 2


def _joined_by_type(rows, types):
    """R3 by its definition: a stage split, then two type splits, each a chain of full joins."""
    def full(left, right, keys, n_left, n_right):
        out = []
        for k in dict.fromkeys([r[0] for r in left] + [r[0] for r in right]):
            ls = [r[1] for r in left if r[0] == k] or [(None,) * n_left]
            rs = [r[1] for r in right if r[0] == k] or [(None,) * n_right]
            out += [(k, a + b) for a in ls for b in rs]
        return out

    def split(rows, keys, kind, value):
        acc = None
        for i, t in enumerate(types):
            part = [(keys(r), (value(r),)) for r in rows if kind(r) == t]
            acc = part if acc is None else full(acc, part, keys, i, 1)
        return acc

    e = [(i, (t, v)) for i, s, t, v in rows if s == 1]
    x = [(i, (t, v)) for i, s, t, v in rows if s == 3]
    wide = full(e, x, None, 2, 2)
    step1 = split(wide, lambda r: (r[0], r[1][2], r[1][3]), lambda r: r[1][0], lambda r: r[1][1])
    step2 = split(step1, lambda r: (r[0][0], r[1]), lambda r: r[0][1], lambda r: r[0][2])
    return sorted(((k[0], *k[1], *v) for k, v in step2), key=str)


def test_type_products_equal_the_joins(spark):
    """Repeated responses, null responses, unlisted types and one-stage enrollments, against the chain of joins."""
    import random

    from kinlink.operators.reshape import type_stage_wide
    r = random.Random(4)
    types = [5, 6, 7]
    for size in (6, 60, 140):
        rows = [(r.choice([1, 2, 3, 4, 5, 6, 7, None]), r.choice([1, 1, 3, 3, 2]), r.choice([5, 6, 7, 8, None]), r.choice([0, 1, None]))
                for _ in range(size)]
        rows = rows[:60] + list(dict.fromkeys(rows[60:]))
        df = spark.createDataFrame(rows, "id int, stage int, type int, response int")
        got = type_stage_wide(df, "id", "stage", "type", "response", 1, 3, [(t, f"t{t}") for t in types])
        assert sorted(map(tuple, got.collect()), key=str) == _joined_by_type(rows, types)


def test_type_products_scan_once(spark, tmp_path):
    """All six types: one scan and two exchanges behind the read, three with its keep-last."""
    spark.createDataFrame([(1, 1, 5, 0)], "id int, stage int, type int, response int").write.parquet(str(tmp_path / "t"))
    from kinlink.functions import codes
    from kinlink.operators.reshape import type_stage_wide
    wide = type_stage_wide(spark.read.parquet(str(tmp_path / "t")), "id", "stage", "type", "response", 1, 3, codes.DISABILITY_TYPES)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count(" Exchange ") == 2 and "Join" not in plan


def test_keep_last_carries_each_value_once(spark):  # order columns are not shuffled beside the row that holds them
    from kinlink.operators import dedup
    df = spark.createDataFrame([(1, "a", None, 2), (1, "b", 7, 1), (None, "c", 1, 1), (None, "d", None, 3), (2, "e", None, None)],
                               "k int, v string, x int, ord int")
    got = dedup.keep_last(df, ["k"], ["ord"])
    assert "max_by" not in got._jdf.queryExecution().toString()
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "a", None, 2), (None, "d", None, 3), (2, "e", None, None)], key=str)
    maps = df.selectExpr("k", "map(v, x) AS m", "ord")      # a map has no order: as before
    assert sorted((r.k or 0, *r.m) for r in dedup.keep_last(maps, ["k"], ["ord"]).collect()) == [(0, "d"), (1, "a"), (2, "e")]
    assert "max_by" in dedup.keep_last(maps, ["k"], ["ord"])._jdf.queryExecution().toString()


def test_whole_number_text_forms(spark):
    from pyspark.sql import functions as F
    from kinlink.functions import recode as rc
    forms = {"7.0": "7", " +7. ": "7", "-3.00": "-3", "7": "7", "+7": "+7", "7.5": "7.5", "a.0": "a.0", ".0": ".0", "": "", None: None}
    df = spark.createDataFrame([(k,) for k in forms], "t string").select("t", rc.whole_number_text(F.col("t")).alias("w"))
    assert {r.t: r.w for r in df.collect()} == forms
