"""Table configuration.

A configuration is a JSON object per table (key columns, columns to drop,
code columns, time columns, stage codes), read on the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def get_metadata_dict(path: str) -> dict:
    """Read a JSON configuration from any store that Spark reads; the ``name`` entry is discarded."""
    spark = SparkSession.active()
    d = json.loads(spark.read.text(path, wholetext=True).first()[0])
    d.pop("name", None)
    return d
