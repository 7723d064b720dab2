"""Aggregations.

Group filters are ``groupBy`` counts joined back (map-side combine, AQE
skew split) rather than windows over the raw rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes


def groups_only(df: DataFrame, group: str, min_size: int = 2) -> DataFrame:
    """A1: rows whose group has at least ``min_size`` rows; null groups drop."""
    big = (df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") >= min_size).select(group))
    return df.join(big, group, "left_semi")


def max_per_key(df: DataFrame, key: str, max_cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A3: per key, the max of ``max_cols`` and the first row's other values."""
    max_cols = [c for c in max_cols if c in df.columns]
    others = [c for c in df.columns if c != key and c not in max_cols and c not in order]
    aggs = [F.max(c).alias(c) for c in max_cols]
    if others:
        aggs.append(F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    g = df.groupBy(key).agg(*aggs)
    sel = [F.col(key)] + [F.col(c) for c in max_cols] + [F.col("_first")[c].alias(c) for c in others]
    return g.select(*sel)


def earliest_per_key(df: DataFrame, key: str, date_col: str, out: str = "first_entry") -> DataFrame:
    """A4: earliest date per key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(date_col).alias(out))


def frequent_values(df: DataFrame, date_col: str, min_freq: int,
                    min_year: int = codes.BAD_DOB_MIN_YEAR,
                    max_year: int = codes.BAD_DOB_MAX_YEAR) -> DataFrame:
    """Dates that are impossible (year > max or < min) or too frequent.

    Returns ``(value, n)``; the list is small by construction but is kept
    as a DataFrame and used through a join.
    """
    d = F.col(date_col)
    c = df.filter(d.isNotNull()).groupBy(d.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    y = F.year("value")
    return c.filter((y > max_year) | (y < min_year) | (F.col("n") >= min_freq))


def mode_from_counts(c: DataFrame, key: str, value: str, n: str = "n",
                     keep_ties: bool = True) -> DataFrame:
    """A7 on a table of counts ``(key, value, n)``: the most frequent values.

    The counts table has one row per (key, value), so the per-key window or
    aggregation here runs on already-combined data.
    """
    if keep_ties:
        w = Window.partitionBy(key)
        return c.withColumn("_m", F.max(n).over(w)).filter(F.col(n) == F.col("_m")).drop("_m")
    rank = F.struct((-F.col(n)).alias("a"), F.col(value).isNull().alias("b"), F.col(value).alias("c"))
    return c.groupBy(key).agg(F.min_by(F.struct(F.col(value), F.col(n)), rank).alias("_p")) \
            .select(key, F.col("_p")[value].alias(value), F.col("_p")[n].alias(n))


def modal_value(df: DataFrame, key: str, value: str, keep_ties: bool = True) -> DataFrame:
    """Most frequent value per key (null counts as a value).

    ``keep_ties=True`` keeps every tied value (the reference multiplies rows
    later); otherwise the smallest value wins, nulls last.  Counting is one
    map-side-combined aggregation.
    """
    c = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    return mode_from_counts(c, key, value, "n", keep_ties)


def furthest_ends(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """``keys, _s, _e``: the furthest end of the intervals that start on a day.

    A union of intervals depends on nothing else, so a key keeps one row a
    day however many intervals it has; partial aggregation makes them in
    each input partition.  Intervals without a day (null or reversed) go.
    """
    s, e = F.col(start).cast("date"), F.col(end).cast("date")
    return (df.filter(s.isNotNull() & e.isNotNull() & (e > s)).groupBy(*keys, s.alias("_s")).agg(F.max(e).alias("_e")))


def union_days(ends: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Days of the union per key, from furthest ends that may have more keys.

    In order of starts an interval adds what reaches past the furthest end
    before it.  The window of a key has at most one row a calendar day.
    """
    merged = ends.groupBy(*keys, "_s").agg(F.max("_e").alias("_e"))
    before = F.max("_e").over(Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1))
    add = F.greatest(F.lit(0), F.datediff("_e", F.greatest(F.col("_s"), F.coalesce(before, F.col("_s")))))
    return merged.select(*keys, add.alias("_add")).groupBy(*keys).agg(F.sum("_add").cast("long").alias(out))


def with_totals(df: DataFrame, totals: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """``df`` with the total of its keys (equal nulls), 0 where there is none."""
    t = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(out).alias("_tot"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(t, same, "left").withColumn(out, F.coalesce("_tot", F.lit(0)).cast("long")).drop("_tot", *[f"_k{i}" for i in range(len(keys))])


def covered_days(df: DataFrame, keys: Sequence[str], start: str, end: str, out: str = "covered_days") -> DataFrame:
    """Days covered by the union of ``[start, end)`` per key, on every row.

    Intervals shrink to the furthest end of each key and day before they
    meet, so a key holding a third of all rows is a few thousand rows.
    Totals are joined back (null-safe).  Rows with a null bound add nothing.
    """
    return with_totals(df, union_days(furthest_ends(df, keys, start, end), keys, out), keys, out)
