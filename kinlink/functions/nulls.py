"""Three-valued (R-style) logic as Spark column expressions.

Spark's ``when`` treats a null condition as false and falls through to the
next branch; R's ``if_else`` returns NA.  These helpers reproduce the R
behaviour so ported rules keep their nulls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def if_else3(cond: Column, yes, no) -> Column:
    """R ``if_else``: null condition gives null."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, lit_or_col(yes)).otherwise(lit_or_col(no))


def r_in(col: Column, values) -> Column:
    """R ``%in%``: never null (null is only in a list holding null)."""
    return F.coalesce(col.isin(list(values)), F.lit(False))


def r_sum(col: Column, window) -> Column:
    """R ``sum`` over a window: null as soon as one input is null."""
    nulls = F.sum(F.when(col.isNull(), 1).otherwise(0)).over(window)
    return F.when(nulls > 0, F.lit(None)).otherwise(F.sum(col).over(window))


def r_any(col: Column, window) -> Column:
    """R ``any``: TRUE if one TRUE, else NA if any NA, else FALSE."""
    n_true = F.sum(F.when(col, 1).otherwise(0)).over(window)
    n_null = F.sum(F.when(col.isNull(), 1).otherwise(0)).over(window)
    return F.when(n_true > 0, F.lit(True)).when(n_null > 0, F.lit(None)).otherwise(F.lit(False))


def r_paste(*cols, sep: str = "") -> Column:
    """R ``paste``: a null part is written as the text ``NA``."""
    parts = [F.coalesce(lit_or_col(c).cast("string"), F.lit("NA")) for c in cols]
    return F.concat_ws(sep, *parts)


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds)


def all_of(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)
