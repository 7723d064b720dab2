"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but space and \t \n \v \f \r.
#: ``bytes.split()`` with no argument splits UTF-8 at exactly these bytes.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

#: Rows that a Python helper holds as Python objects at a time.
ROWS_AT_ONCE = 256


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package (as ``spark.executorEnv.PYTHONPATH`` would).

    On a cluster where the package lies elsewhere, hand it over with
    ``--py-files`` as usual; the extra entry then names no folder and is
    skipped by Python.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([root, *parts])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that few whole texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def least_hashed(rows: DataFrame, key: str, most: int) -> DataFrame:
    """The ``most`` rows with the smallest hash of ``key``, one a key.

    A count of the different keys (to a few percent) says below which hash
    about twice as many lie; only these are ranked, so what tasks send grows
    with ``most`` and not with ``rows``.
    """
    share = 2 * most / max(1, rows.agg(F.approx_count_distinct(key)).first()[0])
    if share < 1:
        rows = rows.filter(F.xxhash64(key) < F.lit(int(share * 2.0 ** 64) - 2 ** 63))
    return rows.dropDuplicates([key]).orderBy(F.xxhash64(key), key).limit(most)
