"""Sinks.  Parquet by default; CSV kept for hand-off files."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Write a result; ``partition_by`` (e.g. agency) gives folder pruning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def numbered_rows(spark: SparkSession, path: str, out: str = "row_number") -> DataFrame:
    """A written Parquet table with the place of each row in it, from 1 (files by name, then rows as they lie).

    A sorted result is written in order, so this is the order that a reader
    finds.  File offsets are one row a file.
    """
    df = spark.read.parquet(path)
    rows = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    before = F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select("_file", F.coalesce(before, F.lit(0)).alias("_off"))
    return (rows.join(F.broadcast(files), "_file").withColumn(out, (F.col("_off") + F.col("_at") + 1).cast("long"))
                .drop("_file", "_at", "_off"))
