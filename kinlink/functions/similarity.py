"""L2 / L3 comparison features for record linkage.

String similarity: Jaro-Winkler has no Spark built-in, so it runs as an
Arrow-batched pandas UDF.  Callers apply it to *distinct value pairs* only
(see ``operators.linkage``), never to every record pair, after a bound from
lengths, characters and prefixes (``may_reach``) in the JVM.  Levenshtein similarity
is a JVM built-in and needs no Python at all.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

# ---------------------------------------------------------------------------
# FIXED VALUES: date comparison credits.
# Same year with month and day swapped scores 0.5; same year and day with
# these month mix-ups scores 0.5.
SWAP_MONTH_DAY_CREDIT = 0.5
SWAP_MONTHS = [(6, 7, 0.5), (7, 6, 0.5), (9, 10, 0.5), (10, 9, 0.5)]
# Winkler prefix: up to 4 characters, scale 0.1, applied above Jaro 0.7.
WINKLER_PREFIX = 4
WINKLER_SCALE = 0.1
WINKLER_BOOST_THRESHOLD = 0.7
# ---------------------------------------------------------------------------


def _ship_by_value() -> None:
    """Serialize this module's functions by value in UDF closures, so
    executors run the similarity code without having kinlink installed."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: fall back to import by name
        pass


_ship_by_value()


def jaro_winkler(s1: str, s2: str) -> float:
    """Jaro-Winkler similarity of two strings (0 when either is empty)."""
    if s1 == s2:
        return 1.0 if s1 else 0.0
    n1, n2 = len(s1), len(s2)
    if n1 == 0 or n2 == 0:
        return 0.0
    window = max(max(n1, n2) // 2 - 1, 0)
    used2 = [False] * n2
    matched1 = []
    for i, ch in enumerate(s1):
        lo = max(0, i - window)
        hi = min(n2, i + window + 1)
        for j in range(lo, hi):
            if not used2[j] and s2[j] == ch:
                used2[j] = True
                matched1.append(ch)
                break
    m = len(matched1)
    if m == 0:
        return 0.0
    matched2 = [s2[j] for j in range(n2) if used2[j]]
    half_t = sum(1 for a, b in zip(matched1, matched2) if a != b) // 2
    jaro = (m / n1 + m / n2 + (m - half_t) / m) / 3.0
    if jaro > WINKLER_BOOST_THRESHOLD:
        prefix = 0
        for a, b in zip(s1[:WINKLER_PREFIX], s2[:WINKLER_PREFIX]):
            if a != b:
                break
            prefix += 1
        jaro += prefix * WINKLER_SCALE * (1.0 - jaro)
    return jaro


@pandas_udf(DoubleType())
def jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Arrow batch UDF; null in, null out."""
    out = [None if (x is None or y is None) else jaro_winkler(x, y)
           for x, y in zip(a.where(a.notna(), None), b.where(b.notna(), None))]
    return pd.Series(out, dtype="float64")


def string_similarity(a: Column, b: Column, method: str = "jarowinkler") -> Column:
    """Similarity in [0, 1]; null when either side is null."""
    if method == "jarowinkler":
        sim = jaro_winkler_udf(a, b)
    elif method in ("levenshtein", "damerau_levenshtein"):
        longest = F.greatest(F.length(a), F.length(b))
        sim = F.when(longest == 0, F.lit(1.0)).otherwise(
            1.0 - F.levenshtein(a, b) / longest)
    elif method == "exact":
        sim = (a == b).cast("double")
    else:
        raise ValueError(f"unknown string method {method!r}")
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(a == b, F.lit(1.0)).otherwise(sim)


def may_reach(a: Column, b: Column, method: str, threshold: float) -> Column:
    """False where the similarity of ``a`` and ``b`` surely lies below ``threshold``.

    Jaro-Winkler: at most as many characters match as either text has
    characters that occur in the other, no transposition is the best case,
    and the prefix adds its share where the plain score allows it.
    """
    if method != "jarowinkler":
        return F.lit(True)
    n1, n2 = F.length(a), F.length(b)
    gone = F.lit("")
    most = F.least(n1 - F.length(F.call_function("translate", a, b, gone)), n2 - F.length(F.call_function("translate", b, a, gone)))
    jaro = F.when(most > 0, (most / n1 + most / n2 + 1) / 3.0).otherwise(F.lit(0.0))
    prefix = sum((F.when(F.left(a, F.lit(k)) == F.left(b, F.lit(k)), 1).otherwise(0) for k in range(1, WINKLER_PREFIX + 1)), F.lit(0))
    best = F.when(jaro > WINKLER_BOOST_THRESHOLD, jaro + prefix * WINKLER_SCALE * (1.0 - jaro)).otherwise(jaro)
    return F.coalesce(best >= F.lit(threshold - 1e-9), F.lit(True))


def date_feature(a: Column, b: Column) -> Column:
    """L3: 1 when equal, partial credit for day/month swaps, null if missing."""
    same_year = F.year(a) == F.year(b)
    expr = F.when(a.isNull() | b.isNull(), F.lit(None)).when(
        F.to_date(a) == F.to_date(b), F.lit(1.0))
    expr = expr.when(same_year & (F.month(a) == F.dayofmonth(b)) & (F.dayofmonth(a) == F.month(b)),
                     F.lit(SWAP_MONTH_DAY_CREDIT))
    for m1, m2, credit in SWAP_MONTHS:
        expr = expr.when(same_year & (F.month(a) == m1) & (F.month(b) == m2)
                         & (F.dayofmonth(a) == F.dayofmonth(b)), F.lit(credit))
    return expr.otherwise(F.lit(0.0))
