"""Stage rows to entry/exit columns.

R1's definition is a chain of null-safe full outer joins, one per
category: several rows for one key and category multiply, null keys match
each other.  When (key, category) is known to be unique the same result is
a single conditional aggregation (one shuffle, map-side combine); callers
opt in with ``unique=True``.  R3, which would chain such joins over stages and
types, multiplies each enrollment's responses instead: one scan, two
exchanges, whatever the number of types.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import codes


def _as_list(x) -> list:
    return list(x) if isinstance(x, (list, tuple)) else [x]


def null_safe_full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on ``keys`` where null keys are equal; keys coalesced."""
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_rk_{k}")) for k in keys])
    j = left.join(r, cond, "full")
    others = [c for c in j.columns if c not in keys and not c.startswith("_rk_")]
    return j.select(*[F.coalesce(F.col(k), F.col(f"_rk_{k}")).alias(k) for k in keys], *others)


def split_rows_to_columns(df: DataFrame, category_column: str, category_suffix: Mapping,
                          merge_columns, unique: bool = False) -> DataFrame:
    """One column set per category, suffixed, joined on ``merge_columns``.

    Categories are the keys of ``category_suffix`` (declared schema: every
    listed category gets its columns even when no row has it).  Rows with a
    null or unlisted category are ignored.
    """
    if isinstance(category_column, (list, tuple)):
        raise TypeError(f"category_column must name one column, not {category_column!r}")
    keys = _as_list(merge_columns)
    values = [c for c in df.columns if c not in keys and c != category_column]
    cats = list(category_suffix.items())
    cat = F.col(category_column)
    df = df.filter(cat.isin([k for k, _ in cats]))
    if unique:
        aggs = [F.first(F.when(cat == F.lit(k), F.col(v)), ignorenulls=True).alias(v + sfx)
                for k, sfx in cats for v in values]
        return df.groupBy(*keys).agg(*aggs)
    parts = [df.filter(cat == F.lit(k)).select(*keys, *[F.col(v).alias(v + sfx) for v in values])
             for k, sfx in cats]
    return reduce(lambda a, b: null_safe_full_join(a, b, keys), parts)


def entry_exit_wide(df: DataFrame, stage_column: str, entry_val, exit_val, enrollment_id: str,
                    suffixes: Sequence[str] = codes.ENTRY_EXIT_SUFFIX, unique: bool = False,
                    listed: Sequence = (), observation: Observation | None = None) -> DataFrame:
    """R2 after the read: keep entry and exit stage rows, split them to columns.

    Update, annual-assessment, post-exit, unlisted and null stages drop out.
    ``observation`` receives ``n_unlisted`` (P6): rows whose stage is neither
    entry nor exit nor one of ``listed``, once the result is computed.
    """
    if observation is not None:
        known = F.col(stage_column).isin([entry_val, exit_val, *listed])
        df = df.observe(observation, F.count_if(F.coalesce(~known, F.lit(True))).alias("n_unlisted"))
    return split_rows_to_columns(df, stage_column, {entry_val: suffixes[0], exit_val: suffixes[1]},
                                 enrollment_id, unique=unique)


def type_stage_wide(df: DataFrame, enrollment_id: str, stage_column: str, type_column: str,
                    response_column: str, entry_val, exit_val, type_names: Sequence,
                    suffixes: Sequence[str] = codes.ENTRY_EXIT_SUFFIX,
                    one_row: bool = False) -> DataFrame:
    """``<Type>_entry`` / ``<Type>_exit`` response columns per enrollment.

    The rows are those of a stage split and two type splits with R1's joins:
    several responses of one enrollment, stage and type give several rows,
    and an enrollment needs rows at both stages.  They are made in one pass
    as products of each enrollment's responses.  ``one_row=True`` is one conditional
    aggregation instead: the largest response of each stage and type, one
    row an enrollment, those with one stage included.
    """
    types = [(int(k), v) for k, v in type_names]
    if one_row:
        stages = [(entry_val, suffixes[0]), (exit_val, suffixes[1])]
        st, ty, rs = F.col(stage_column), F.col(type_column), F.col(response_column)
        aggs = [F.max(F.when((st == F.lit(s)) & (ty == F.lit(t)), rs)).alias(f"{name}{sfx}")
                for s, sfx in stages for t, name in types]
        return (df.filter(st.isin([s for s, _ in stages]) & ty.isin([t for t, _ in types]))
                  .groupBy(enrollment_id).agg(*aggs))
    return _type_products(df.select(enrollment_id, stage_column, type_column, response_column), enrollment_id, stage_column, type_column,
                          response_column, (entry_val, exit_val), types, suffixes)


def _type_products(df: DataFrame, key: str, stage: str, kind: str, response: str, stages: Sequence, types: Sequence[tuple],
                   suffixes: Sequence[str]) -> DataFrame:
    """The rows that R1's joins of stages and types give, from one pass.

    Responses are counted per key, stage and type, and gathered one row a
    key: the joins give each combination of one response a type and stage,
    types without one being null, for keys with some type at both stages.
    Equal rows multiply as in the joins: a split by type pairs every type's
    rows with each other, so a response that occurs ``n`` times counts ``n``
    times for each type of the other stage.
    """
    rows = df.filter(F.col(stage).isin(list(stages)) & F.col(kind).isin([t for t, _ in types]))
    seen = rows.groupBy(key, stage, kind, response).agg(F.count(F.lit(1)).alias("_n"))
    cells = [(s, t, name + sfx) for s, sfx in zip(stages, suffixes) for t, name in types]
    given = F.struct(F.col(response).alias("response"), F.col("_n").alias("n"))
    wide = seen.groupBy(key).agg(*[F.collect_list(F.when((F.col(stage) == F.lit(s)) & (F.col(kind) == F.lit(t)), given)).alias(f"_c{i}")
                                   for i, (s, t, _) in enumerate(cells)])
    entry, exit_ = range(len(types)), range(len(types), len(cells))
    present = {part: reduce(lambda a, b: a + b, [(F.size(f"_c{i}") > 0).cast("int") for i in part]) for part in (entry, exit_)}
    wide = wide.select("*", present[entry].alias("_p"), present[exit_].alias("_q")).filter("_p > 0 AND _q > 0")
    for i, _ in enumerate(cells):
        # a type without response is one null
        none = F.array(F.struct(F.lit(None).alias("response"), F.lit(1).cast("long").alias("n")))
        wide = wide.withColumn(f"_c{i}", F.explode(F.when(F.size(f"_c{i}") > 0, F.col(f"_c{i}")).otherwise(none)))
    times = {part: reduce(lambda a, b: a * b, [F.col(f"_c{i}.n") for i in part]) for part in (entry, exit_)}
    n = F.pow(times[entry], "_q") * F.pow(times[exit_], "_p")
    return (wide.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), n.cast("int"))))
                .select(key, *[F.col(f"_c{i}.response").alias(name) for i, (_, _, name) in enumerate(cells)]))
