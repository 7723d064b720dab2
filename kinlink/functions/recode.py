"""Scalar recodes as Spark column expressions (no Python UDFs).

P3 recode_unknown, P4 parse_dates, P5 null tokens, P9 name exclusion,
P10 refused names, P11-P14 SSN rules, P15 date parts, P16 upper case,
P17 gender, P18 race flags, P19 prefixed ids, P20 program category.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import codes
from .nulls import r_paste

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)

# pandas reads these texts as missing; R's fread reads "" as missing.
DEFAULT_NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                       "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                       "nan", "null"]


def _present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def recode_unknown(df: DataFrame, cols: Sequence[str],
                   unknown=codes.UNKNOWN_CODES) -> DataFrame:
    """Listed codes become null in the given columns (any list length).

    Comparison is numeric when the column is numeric; text columns are
    compared against the codes written as text too ("8" and "8.0").
    """
    unknown = list(unknown)
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c in cols:
            if types[c] == "string":
                texts = [str(u) for u in unknown] + [f"{float(u)}" for u in unknown
                                                     if isinstance(u, (int, float))]
                expr = F.when(F.trim(F.col(c)).isin(texts), F.lit(None)).otherwise(F.col(c))
            else:
                expr = F.when(F.col(c).isin(unknown), F.lit(None)).otherwise(F.col(c))
            out.append(expr.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def whole_number_text(col: Column) -> Column:
    """Text of a whole number without a fraction ("1.0" is "1"); other text unchanged."""
    # few values have a point, the others need no pattern
    return F.when(F.contains(col, F.lit(".")) & col.rlike(r"^\s*[+-]?[0-9]+\.0*\s*$"), F.regexp_extract(col, r"^\s*\+?(-?[0-9]+)", 1)).otherwise(col)


def _as_double(c: str) -> Column:
    return F.trim(F.col(c)).try_cast("double")


def number_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """For each listed text column two aggregates: its values that are no numbers (``text:c``), and
    its numbers that are not whole (``part:c``)."""
    types, found = dict(df.dtypes), {}
    for c in dict.fromkeys(cols):
        if types.get(c) == "string":
            number = _as_double(c)
            found[f"text:{c}"] = F.count_if(F.col(c).isNotNull() & number.isNull())
            found[f"part:{c}"] = F.count_if(number.isNotNull() & ~((number == F.floor(number)) & (F.abs(number) < 2.0 ** 63)))
    return found


def typed_numbers(df: DataFrame, seen: dict[str, int]) -> DataFrame:
    """Text columns whose every value is a number become numbers.

    As when a reader infers types, a column is whole numbers if all its
    values are, else doubles if all are numbers, else it stays text.
    ``seen`` holds the values of ``number_counts``; columns without one are
    left alone.
    """
    to = {c: "double" if seen[f"part:{c}"] else "bigint" for c in df.columns if seen.get(f"text:{c}") == 0}

    def typed(c: str) -> Column:
        if to[c] == "double":
            return _as_double(c)
        # text of whole numbers keeps all digits; "1.0" goes by way of a double
        return F.coalesce(F.trim(F.col(c)).try_cast("bigint"), _as_double(c).cast("bigint"))

    return df.select(*[typed(c).alias(c) if c in to else F.col(c) for c in df.columns])


def parse_date_col(col: Column, dtype: str, as_date: bool = False) -> Column:
    """P4 for one column: bad input becomes null, never an error (ANSI safe).

    Text is parsed with ``try_cast`` (yyyy, yyyy-MM, yyyy-MM-dd and full
    timestamps are accepted; a four-digit year means 1 January).  Integer
    columns holding a four-digit year become 1 January of that year.
    """
    target = "date" if as_date else "timestamp_ntz"
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        return col.cast(target)
    if dtype in ("int", "bigint", "smallint", "tinyint"):
        d = F.when((col >= 1) & (col <= 9999), F.make_date(col.cast("int"), F.lit(1), F.lit(1)))
        return d.cast(target)
    txt = F.trim(col.cast("string"))
    txt = F.regexp_replace(txt, "/", "-")
    return txt.try_cast(target)


def parse_dates(df: DataFrame, cols: Sequence[str], as_date: bool = False) -> DataFrame:
    """Coerce the listed columns to timestamps (or dates)."""
    types = dict(df.dtypes)
    return df.select(*[parse_date_col(F.col(c), types[c], as_date).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def null_tokens(df: DataFrame, cols: Sequence[str] | None = None,
                tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """P5: text that means 'missing' becomes null in string columns."""
    types = dict(df.dtypes)
    cols = [c for c in (cols or df.columns) if types.get(c) == "string"]
    toks = list(tokens)
    return df.select(*[F.when(F.trim(F.col(c)).isin(toks) | (F.trim(F.col(c)) == ""), F.lit(None))
                       .otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def name_keep(df: DataFrame, name_cols: Sequence[str],
              exclusion: Sequence[str] = codes.NAME_EXCLUSION) -> Column:
    """True for rows whose every name column looks like a real name.

    A name fails when it is null, not text, contains an excluded token
    (after lower-casing and removing '.'), is one character long, or holds
    a digit.
    """
    types = dict(df.dtypes)
    # one pattern a column: '.' may stand anywhere in an excluded token, as it
    # is ignored; one character, dots aside; any digit
    tokens = [r"\.*".join(re.escape(x) for x in t) for t in exclusion]
    pattern = "|".join([r"\p{Nd}", r"^\.*[^.]\.*\z", *tokens])
    conds = []
    for c in name_cols:
        if types.get(c) != "string":
            conds.append(F.lit(False))
            continue
        conds.append(F.col(c).isNotNull() & ~F.lower(F.col(c)).rlike("(?s)" + pattern))
    return reduce(lambda a, b: a & b, conds)


def exclude_names(df: DataFrame, name_cols: Sequence[str],
                  exclusion: Sequence[str] = codes.NAME_EXCLUSION) -> DataFrame:
    return df.filter(F.coalesce(name_keep(df, name_cols, exclusion), F.lit(False)))


def refused_name_keep(cols: Sequence[str],
                      tokens: Sequence[str] = codes.REFUSED_NAME_TOKENS) -> Column:
    """P10: drop rows whose name holds a refused token; null names are kept."""
    conds = [~F.coalesce(F.col(c).contains(t), F.lit(False)) for c in cols for t in tokens]
    return reduce(lambda a, b: a & b, conds)


def clean_ssn(col: Column) -> Column:
    """11111111, 22222222 ... 88888888 (eight digits) become null."""
    bad = [11111111 * i for i in range(1, 9)]
    num = col.cast("string").try_cast("double")
    return F.when(num.isin(bad), F.lit(None)).otherwise(col)


def stringify_ssn(col: Column, lpad9: bool = False) -> Column:
    """Number to integer text (no padding unless asked), null stays null."""
    txt = col.cast("string").try_cast("double").cast("bigint").cast("string")
    return F.lpad(txt, 9, "0") if lpad9 else txt


def ssn_digits(col: Column) -> Column:
    """SSN as a number's text, the way R's ``nchar(as.numeric(x))`` sees it."""
    return col.cast("string").try_cast("double").cast("bigint").cast("string")


def ssn_quality_pha(ssn: Column) -> Column:
    """P13 (housing authority): null = 3, fewer than 9 digits = 2, else 1."""
    d = ssn_digits(ssn)
    return F.when(d.isNull(), 3).when(F.length(d) < 9, 2).otherwise(1)


def ssn_quality_hmis(dq: Column) -> Column:
    """P13 (HMIS): data-quality codes above 2 become 3."""
    return F.when(dq > 2, F.lit(3)).otherwise(dq)


def ssn_repeated_digit(ssn: Column, dq: Column) -> Column:
    """P13 (combined): nine equal digits (0 ... 999999999) give 3; null SSN 3."""
    num = ssn.cast("string").try_cast("double")
    repeated = [111111111 * i for i in range(0, 10)]
    return F.when(num.isNull(), F.lit(3)).when(num.isin(repeated), F.lit(3)).otherwise(dq)


def usable_ssn(ssn: Column, dq: Column) -> Column:
    """SSN kept when quality is 1 and it has nine digits."""
    d = ssn_digits(ssn)
    return F.when((dq == 1) & (F.length(d) == 9), d)


def usable_dob(dob: Column, dq: Column) -> Column:
    """Birth date kept when its quality is 1."""
    return F.when(dq == 1, dob)


def date_parts(df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """Year, month and day columns ``<prefix>_y/_m/_d``."""
    p = prefix or col
    c = F.col(col)
    return (df.withColumn(f"{p}_y", F.year(c))
              .withColumn(f"{p}_m", F.month(c))
              .withColumn(f"{p}_d", F.dayofmonth(c)))


def upper_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P16."""
    return df.select(*[F.upper(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _map_expr(col: Column, pairs) -> Column:
    expr = None
    for k, v in pairs:
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(None))


def gender_hmis(col: Column) -> Column:
    """HMIS 0-4 to Fem/Mal/MTF/FTM/GNC, else null."""
    return _map_expr(col, codes.HMIS_GENDER)


def gender_pha(col: Column) -> Column:
    """Housing-authority text to Fem/Mal, else null."""
    return _map_expr(col, codes.PHA_GENDER)


def gender_prelink(col: Column) -> Column:
    """Housing-authority text to 1 (Female) / 0 (Male), else null."""
    return _map_expr(col, [("Female", 1), ("Male", 0)])


def race_flag(detail: Column, category: Column, only_label: str) -> Column:
    """1 when the detail flag is 1 or the category is '<race> only'.

    Three-valued: an unknown detail with another category stays null.
    """
    return ((detail == 1) | (category == F.lit(only_label))).cast("int")


def prefixed_id(prefix: str, col: Column) -> Column:
    """``paste(prefix, id)``; a null id is written ``NA``."""
    return r_paste(F.lit(prefix), col)


def program_category(agency: Column, pha_parts: Sequence[Column],
                     hmis_parts: Sequence[Column]) -> tuple[Column, Column]:
    """P20: comma-joined program strings; HMIS text ends with a comma."""
    pha = F.when(agency.isin(codes.PHA_AGENCIES), r_paste(agency, *pha_parts, sep=","))
    hmis = F.when(agency == F.lit("HMIS"),
                  F.concat(r_paste(agency, *hmis_parts, sep=","), F.lit(",")))
    return pha, hmis


def seq_id(prefix: str, n: Column) -> Column:
    """W6 text part: ``prefix`` + number padded to six digits (never cut)."""
    return F.concat(F.lit(prefix), F.format_string("%06d", n))
