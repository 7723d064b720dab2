"""S1-S4, P1-P5, U1 (fixtures F1, F2)."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest

from conftest import rows, write_csv
from kinlink.functions import recode as rc
from kinlink.plans import hmis
from kinlink.sources import readers


@pytest.mark.parametrize("paths", [["p1"], ["p1", "p2"], ["p1", "p2", "p3", "p4"]])
def test_std_path_setup(paths):  # F1
    spec = readers.std_path_setup("test", "data", paths)
    assert spec == {p: os.path.join("data", p, "test") for p in paths}


def _f2(tmp_path):
    df = pd.DataFrame({"id": [1, 1, 2, 2],
                       "time1": ["2001-01-13", "2004-05-21", "2003-06-10", "2003-06-10"],
                       "drop1": [2, 3, 4, 5], "ig_dedup1": [5, 6, 7, 8], "categ1": [0, 8, 0, 0]})
    return write_csv(str(tmp_path / "2011"), "t.csv", df)


def test_read_table(spark, tmp_path):  # F2
    f = _f2(tmp_path)
    kw = dict(columns_to_drop=["drop1"], categorical_var=["categ1"], time_var=["time1"],
              duplicate_check_columns=["id", "time1", "categ1"])
    df = hmis.read_table(spark, {"2011": f}, **kw)
    assert "drop1" not in df.columns
    got = rows(df, ["id", "time1", "ig_dedup1", "categ1"], key=["id", "time1"])
    assert got == [
        {"id": "1", "time1": dt.datetime(2001, 1, 13), "ig_dedup1": "5", "categ1": 0},
        {"id": "1", "time1": dt.datetime(2004, 5, 21), "ig_dedup1": "6", "categ1": None},
        {"id": "2", "time1": dt.datetime(2003, 6, 10), "ig_dedup1": "8", "categ1": 0},
    ]
    # string file name with data_dir and paths gives the same table
    df2 = hmis.read_table(spark, "t.csv", data_dir=str(tmp_path), paths=["2011"], **kw)
    assert rows(df2, ["id", "time1", "ig_dedup1", "categ1"], key=["id", "time1"]) == got


def test_read_table_errors(spark, tmp_path):  # S4
    f = _f2(tmp_path)
    with pytest.raises(ValueError):
        hmis.read_table(spark, {"2011": f}, data_dir="somewhere")
    with pytest.raises(ValueError):
        hmis.read_table(spark, "test", data_dir=None, paths=None)
    with pytest.raises(ValueError):
        readers.resolve_file_spec("test", county=["king"])


def test_stack_by_name_and_newest_wins(spark, tmp_path):  # S3, U1, D1 order
    a = write_csv(str(tmp_path / "2012"), "t.csv", pd.DataFrame({"id": [1, 2], "v": ["old", "x"]}))
    b = write_csv(str(tmp_path / "2013"), "t.csv", pd.DataFrame({"id": [1], "w": ["new"], "v": ["new"]}))
    c = write_csv(str(tmp_path / "2014"), "t.csv", pd.DataFrame({"v": ["last"], "id": [3]}))
    spec = {"2012": a, "2013": b, "2014": c}
    df = hmis.read_table(spark, spec, duplicate_check_columns=["id"])
    got = {r["id"]: (r["v"], r["w"]) for r in df.collect()}
    assert got == {"1": ("new", "new"), "2": ("x", None), "3": ("last", None)}
    # compat order: last folder read first, so the second-to-last wins keep-last
    a2 = write_csv(str(tmp_path / "c1"), "t.csv", pd.DataFrame({"id": [1], "v": ["y2012"]}))
    b2 = write_csv(str(tmp_path / "c2"), "t.csv", pd.DataFrame({"id": [1], "v": ["y2015"]}))
    c2 = write_csv(str(tmp_path / "c3"), "t.csv", pd.DataFrame({"id": [1], "v": ["y2016"]}))
    spec2 = {"2012": a2, "2015": b2, "2016": c2}
    assert hmis.read_table(spark, spec2, duplicate_check_columns=["id"]).collect()[0]["v"] == "y2016"
    assert hmis.read_table(spark, spec2, duplicate_check_columns=["id"],
                           compat_order=True).collect()[0]["v"] == "y2015"


def test_files_are_parsed_once(spark, tmp_path):  # S2, S3: code columns are typed in the pass that reads the files
    a = write_csv(str(tmp_path / "a"), "t.csv", pd.DataFrame({"id": [1, 2], "n": ["1", "2.0"], "d": ["1.5", ""], "t": ["71", "x"]}))
    b = write_csv(str(tmp_path / "b"), "t.csv", pd.DataFrame({"id": [3], "n": [""], "d": ["2"], "t": ["72"]}))
    df = hmis.read_table(spark, {"a": a, "b": b}, categorical_var=["n", "d", "t"], duplicate_check_columns=["id"])
    assert [t for c, t in df.dtypes if c in ("n", "d", "t")] == ["bigint", "double", "string"]
    assert not any(f.endswith(".csv") for f in df.inputFiles())
    got = {r["id"]: (r["n"], r["d"], r["t"]) for r in df.collect()}
    assert got == {"1": (1, 1.5, "71"), "2": (2, None, "x"), "3": (None, 2.0, "72")}


def test_bom_and_null_tokens(spark):  # P1, P5
    df = spark.createDataFrame([("a", "NA"), ("", "x")], ["﻿name", "val"])
    df = readers.strip_bom(df)
    assert df.columns == ["name", "val"]
    got = rc.null_tokens(df).collect()
    assert [(r["name"], r["val"]) for r in got] == [("a", None), (None, "x")]


def test_recode_any_length(spark):  # P3
    df = spark.createDataFrame([(1,), (8,), (9,), (99,), (7,)], ["c"])
    assert [r.c for r in rc.recode_unknown(df, ["c"], [7, 8]).collect()] == [1, None, 9, 99, None]


def test_parse_dates(spark):  # P4
    df = spark.createDataFrame([("2001-01-13",), ("garbage",), (None,), ("1999",), ("2003/06/10",)], ["t"])
    got = [r.t for r in rc.parse_dates(df, ["t"]).collect()]
    assert got == [dt.datetime(2001, 1, 13), None, None, dt.datetime(1999, 1, 1), dt.datetime(2003, 6, 10)]


def test_write_table_partitioned(spark, tmp_path):  # S9
    from kinlink.sources.writers import write_table
    df = spark.createDataFrame([("HMIS", 1), ("SHA", 2)], "agency string, n int")
    out = str(tmp_path / "merged")
    write_table(df, out, partition_by=["agency"])
    back = spark.read.parquet(out).filter("agency = 'SHA'")
    assert [r.n for r in back.collect()] == [2]


def test_materialize_and_clear(spark):
    from kinlink.session import clear_materialized, materialize
    df, path = materialize(spark.range(10), "t")
    assert df.count() == 10
    assert clear_materialized(spark) >= 1
