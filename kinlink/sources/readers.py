"""Read multi-folder extracts as one DataFrame.

Each folder holds the same table for another year.  We read every file on
its own (a single multi-path CSV read aligns columns by *position*) and
stack them with ``unionByName(allowMissingColumns=True)``.  Two order
columns replace pandas row order: ``_src_ord`` (position of the folder in
the list) and ``_row_ord`` (file, block and row position).  Keep-last dedup
uses them; newest folder wins.
"""

from __future__ import annotations

import os
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SRC_ORD = "_src_ord"
ROW_ORD = "_row_ord"

# Folder layout of the county extracts (FIXED VALUES).
COUNTY_FOLDERS = {"king": ["2012", "2013", "2014", "2015", "2016"],
                  "pierce": ["2012_2016"], "snohomish": ["2012_2016"]}


def std_path_setup(filename: str, data_dir: str, paths: Sequence[str]) -> dict:
    """``{folder: data_dir/folder/filename}`` in folder order."""
    return {p: os.path.join(data_dir, p, filename) for p in paths}


def resolve_file_spec(file_spec, county=None, data_dir=None, paths=None) -> dict:
    """Argument checks of the reference, raised on the driver."""
    if isinstance(file_spec, Mapping):
        if data_dir is not None or paths is not None:
            raise ValueError("file_spec names its files itself: leave out data_dir and paths")
        return dict(file_spec)
    if county is not None and not isinstance(county, str):
        raise ValueError("county must be one name")
    if data_dir is None:
        if county is None:
            raise ValueError("a file name needs data_dir or county")
        data_dir = os.path.join("data", county)
    if paths is None:
        if county is None:
            raise ValueError("a file name needs paths or county")
        paths = COUNTY_FOLDERS[county]
    return std_path_setup(file_spec, data_dir, paths)


def strip_bom(df: DataFrame) -> DataFrame:
    """Drop a leading U+FEFF from column names."""
    cleaned = [c[1:] if c.startswith("﻿") else c for c in df.columns]
    return df.toDF(*cleaned) if cleaned != df.columns else df


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def ordered(df: DataFrame, source: int, file=None, block=None) -> DataFrame:
    """``df`` without a byte-order mark in its names, and with the two order columns."""
    row = F.struct((F.lit(None) if file is None else file).cast("string").alias("file"),
                   (F.lit(None) if block is None else block).cast("bigint").alias("block"),
                   F.monotonically_increasing_id().alias("row"))
    return strip_bom(df).withColumn(SRC_ORD, F.lit(source)).withColumn(ROW_ORD, row)


def read_one(spark: SparkSession, path: str, fmt: str = "csv", encoding: str | None = None,
             schema=None, multi_line: bool = False, source: int = 0) -> DataFrame:
    """One extract (a file, or a folder of its parts); CSV is read as text, types come later.

    Rows are ordered by file name, then by the place of their block in the
    file, then by their place in it: tasks get blocks by size, not in order.
    """
    if fmt == "csv":
        r = spark.read.option("header", True).option("inferSchema", False)
        r = r.option("multiLine", multi_line).option("escape", '"')
        if encoding:
            r = r.option("encoding", encoding)
        if schema is not None:
            r = r.schema(schema)
        df = r.csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    if "_metadata" in df.columns:
        return ordered(df, source)
    return ordered(df, source, F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
