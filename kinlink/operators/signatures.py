"""Equi-join keys that every pair of similar strings shares.

Two strings can only be similar if enough of their characters agree: for
Jaro-Winkler a number that follows from both lengths, the threshold and the
length of their common beginning, for Levenshtein from the longer length.
Characters count with their occurrence ("the second a"), so they are sets,
and sets that share ``m`` of their members share at least ``l`` of the first
``n - m + l`` ones in any fixed order.  Every combination of ``l`` of these is
a key, together with the bands of both lengths and the common beginning.  The
order is rarest first, which makes keys selective; any order is exact.

A text is a key maker twice, as the shorter and as the longer one of a pair.
Lengths go up in bands of about a quarter, so that a long text meets a few
bands and not every length.  Jaro-Winkler forgives most where texts begin
alike; those pairs have a key of their own, the first three characters.  Pairs
that need nothing in common (very low thresholds) share a key of the bands
alone.
"""

from __future__ import annotations

import math
import sys
from itertools import combinations
from typing import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, StringType

from ..functions.similarity import WINKLER_BOOST_THRESHOLD, WINKLER_SCALE

cloudpickle.register_pickle_by_value(sys.modules[__name__])    # executors need no installed package

#: At most this many combinations a text and band, where one character a key would not give more.
MOST_COMBINATIONS = 40
#: A common beginning of this length is a key; shorter ones count in the least score.
BEGINNING = 3
#: Characters beyond the most frequent ones count as equally rare.
RANKED_CHARACTERS = 4096


def bands(longest: int) -> list[int]:
    """Least lengths of the bands up to ``longest``."""
    out = [0]
    while out[-1] < longest:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return out


def band_of(n: int, starts: Sequence[int]) -> int:
    return max(s for s in starts if s <= n)


def least_score(method: str, threshold: float) -> float:
    """Plain score that similar texts have unless they share ``BEGINNING`` characters at the start."""
    if method != "jarowinkler" or threshold <= WINKLER_BOOST_THRESHOLD:
        return threshold
    extra = (BEGINNING - 1) * WINKLER_SCALE
    return max(WINKLER_BOOST_THRESHOLD, (threshold - extra) / (1 - extra))


def _needed(method: str, least: float, n1: int, n2: int) -> int:
    """Characters that texts of at least ``n1 <= n2`` characters must share."""
    if method == "jarowinkler":
        return math.ceil((3 * least - 1) * n1 * n2 / (n1 + n2) - 1e-9) if n1 + n2 else 0
    return math.ceil(least * max(n1, n2) - 1e-9)


def plans(starts: Sequence[int], method: str, threshold: float) -> list[tuple[int, int, int, int]]:
    """``(band of the shorter, of the longer, characters to share, members of a key)`` of all bands that can meet."""
    least, out = least_score(method, threshold), []
    ends = [*[s - 1 for s in starts[1:]], starts[-1] * 5 // 4]
    for i, low in enumerate(starts):
        for high, end in zip(starts[i:], ends[i:]):
            m = max(0, _needed(method, least, low, high))
            if m > ends[i]:
                continue                        # more than the shorter one can have
            size = next((s for s in (3, 2) if s <= m and math.comb(end - m + s, s) <= MOST_COMBINATIONS), min(m, 1))
            out.append((low, high, m, size))
    return out


def _tokens(text: str, rank: dict[str, int]) -> list[tuple]:
    """Characters with their occurrence, rarest first."""
    seen: dict[str, int] = {}
    out = []
    for ch in text:
        seen[ch] = seen.get(ch, 0) + 1
        out.append((-seen[ch], rank.get(ch, -1), ch))
    return sorted(out)


def keys_of(text: str, longer: bool, starts: Sequence[int], rules: Sequence[tuple], rank: dict[str, int], begins: bool) -> list[str]:
    """Keys of a text as the longer or shorter one of a pair."""
    mine, tokens, out = band_of(len(text), starts), _tokens(text, rank), set()
    if begins and len(text) >= BEGINNING:
        out.add("^" + text[:BEGINNING])
    for low, high, m, size in rules:
        if mine == (high if longer else low):
            for chosen in combinations(tokens[:max(0, len(text) - m + size)], size):
                out.add(f"{low}|{high}|" + "".join(f"{-n}{ch}" for n, _, ch in chosen))
    return sorted(out)


def _maker(longer: bool, starts, rules, rank, begins):
    @pandas_udf(ArrayType(StringType()))
    def keys(texts: pd.Series) -> pd.Series:
        made = {t: keys_of(t, longer, starts, rules, rank, begins) for t in texts.unique()}     # blocks repeat texts
        return pd.Series([made[t] for t in texts], dtype=object)

    return keys


def _measured(values: DataFrame, column: str) -> tuple[int, dict[str, int]]:
    """Longest length, and the rank by frequency of the most frequent characters (the rest is rarer).

    What is collected is one row a different character.
    """
    chars = values.select(F.length(column).alias("n"), F.explode(F.split(column, "")).alias("c"))
    counts = chars.groupBy("c").agg(F.count(F.lit(1)).alias("times"), F.max("n").alias("longest")).collect()
    often = sorted(counts, key=lambda r: (-r["times"], r["c"]))[:RANKED_CHARACTERS]
    return max((r["longest"] for r in counts), default=0), {r["c"]: len(often) - i for i, r in enumerate(often)}


def candidate_pairs(values: DataFrame, block: str, column: str, method: str, threshold: float) -> DataFrame:
    """``block, _va, _vb`` with ``_va < _vb``: pairs of different values in one block that share a key.

    ``values`` holds distinct, non-null values.  Every pair whose similarity
    reaches the threshold is there.
    """
    if method == "exact" and threshold > 0:     # no different values are equal
        return values.select(block, F.col(column).alias("_va"), F.col(column).alias("_vb")).limit(0)
    longest, rank = _measured(values, column)
    starts = bands(longest)
    rules = plans(starts, method, threshold)
    begins = method == "jarowinkler" and threshold > WINKLER_BOOST_THRESHOLD

    def side(longer: bool, name: str) -> DataFrame:
        key: Column = F.explode(_maker(longer, starts, rules, rank, begins)(F.col(column)))
        return values.select(F.col(block).alias(f"_b{name}"), F.col(column).alias(f"_v{name}"), key.alias(f"_k{name}"))

    a, b = side(False, "1"), side(True, "2")
    # the keys of a small file of values may fill gigabytes, so they are not broadcast
    met = a.join(b.hint("merge"), (F.col("_k1") == F.col("_k2")) & (F.col("_b1") == F.col("_b2"))).filter(F.col("_v1") != F.col("_v2"))
    return met.select(F.col("_b1").alias(block), F.least("_v1", "_v2").alias("_va"), F.greatest("_v1", "_v2").alias("_vb")).distinct()
