"""Deduplication and conflict resolution.

Keep-last is an aggregation (``max_by`` over the order columns), not a
window: it combines map-side, so a key holding a large share of the rows
costs one small partial row per input partition instead of one huge sort
in a single task.  Person-level conflict rules aggregate per person and
join the result back (AQE can split a skewed join partition; it cannot
split a window partition).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ._time import diff_micros, midpoint_day

WINDOW_MICROS = codes.CONFLICT_WINDOW_DAYS * 86_400_000_000


def _keep_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    keys = list(dict.fromkeys(keys))
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    if set(order) <= set(rest) and not any(x in t for _, t in df.dtypes for x in ("map<", "variant", "interval")):
        # the order's columns are part of the row: one struct that begins with them, each value once
        row = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *rest])])
        agg = df.groupBy(*keys).agg((F.max if last else F.min)(row).alias("_r"))
    else:
        pick = F.max_by if last else F.min_by
        row = F.struct(*[F.col(c) for c in rest])
        agg = df.groupBy(*keys).agg(pick(row, F.struct(*[F.col(c) for c in order])).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one last in ``order`` (nulls in keys are equal).

    ``order`` must be total (e.g. ``_src_ord, _row_ord``); ``dropDuplicates``
    keeps an arbitrary row and is not used.
    """
    return _keep_by(df, keys, order, last=True)


def _person_stats(df: DataFrame, pid: str, cols: Sequence[str]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs += [F.count(c).alias(f"_cnt_{c}"), F.min(c).alias(f"_min_{c}"),
                 F.max(c).alias(f"_max_{c}")]
    return df.filter(F.col(pid).isNotNull()).groupBy(pid).agg(*aggs)


def _unchanged(c: str) -> Column:
    n, cnt = F.col("_n"), F.col(f"_cnt_{c}")
    same = (cnt == n) & (F.col(f"_min_{c}") == F.col(f"_max_{c}"))
    return n.isNull() | (n == 1) | (cnt == 0) | same


def resolve_time_expr(c: str, dtype: str) -> Column:
    """One valid value fills; several within 365 days -> midpoint day."""
    lo, hi = F.col(f"_min_{c}"), F.col(f"_max_{c}")
    return (F.when(_unchanged(c), F.col(c))
             .when(F.col(f"_cnt_{c}") == 1, hi)
             .when(diff_micros(lo, hi, dtype) < WINDOW_MICROS, midpoint_day(lo, hi, dtype))
             .otherwise(F.lit(None)))


def resolve_bool_expr(c: str) -> Column:
    """Any true wins (max of the valid values)."""
    return F.when(F.col("_n").isNull(), F.col(c)).otherwise(F.col(f"_max_{c}"))


def resolve_code_expr(c: str, agreeing_codes_survive: bool = False) -> Column:
    """One valid row fills; several valid rows that differ in any way -> null."""
    expr = F.when(_unchanged(c), F.col(c)).when(F.col(f"_cnt_{c}") == 1, F.col(f"_max_{c}"))
    if agreeing_codes_survive:
        expr = expr.when(F.col(f"_min_{c}") == F.col(f"_max_{c}"), F.col(f"_max_{c}"))
    return expr.otherwise(F.lit(None))


def resolve_conflicts(df: DataFrame, pid: str, time_cols: Sequence[str] = (),
                      bool_cols: Sequence[str] = (), code_cols: Sequence[str] = (),
                      agreeing_codes_survive: bool = False) -> DataFrame:
    """D5-D7 in one pass: every row of a person gets the resolved values.

    Rows with a null person id pass through unchanged.
    """
    cols = list(dict.fromkeys([*time_cols, *bool_cols, *code_cols]))
    if not cols:
        return df
    types = dict(df.dtypes)
    stats = _person_stats(df, pid, cols)
    j = df.join(stats, on=pid, how="left")
    out = []
    for c in df.columns:
        if c in time_cols:
            out.append(resolve_time_expr(c, types[c]).alias(c))
        elif c in bool_cols:
            out.append(resolve_bool_expr(c).alias(c))
        elif c in code_cols:
            out.append(resolve_code_expr(c, agreeing_codes_survive).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def null_bad_dates(df: DataFrame, pid: str, date_col: str, first_entry: DataFrame,
                   first_col: str = "first_entry",
                   earliest: str = codes.EARLIEST_BIRTH_DATE) -> DataFrame:
    """A birth date after the person's first enrollment or before 1900 -> null.

    ``first_entry`` has one row per person (``A4``).  Persons without an
    enrollment only get the 1900 test.
    """
    j = df.join(first_entry.select(F.col(pid), F.col(first_col).alias("_first")), on=pid, how="left")
    d = F.col(date_col)
    bad = F.coalesce(d > F.col("_first"), F.lit(False)) | F.coalesce(
        d < F.lit(earliest).cast(dict(df.dtypes)[date_col]), F.lit(False))
    return j.select(*[F.when(bad, F.lit(None)).otherwise(d).alias(c) if c == date_col else F.col(c)
                      for c in df.columns])


def bad_date_flag(df: DataFrame, pid: str, date_col: str, first_entry: DataFrame,
                  first_col: str = "first_entry", earliest: str = codes.EARLIEST_BIRTH_DATE) -> Column:
    """D10 helper: the bad-date test as a column (for ``observe`` counts)."""
    d = F.col(date_col)
    return F.coalesce(d > F.col(first_col), F.lit(False)) | F.coalesce(d < F.lit(earliest), F.lit(False))


def reconcile_dates(df: DataFrame, pid: str, date_col: str, keys: Sequence[str],
                    order: Sequence[str]) -> DataFrame:
    """D5 on the surviving birth dates, then keep-last on the client keys."""
    return keep_last(resolve_conflicts(df, pid, time_cols=[date_col]), keys, order)
