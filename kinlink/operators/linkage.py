"""L1-L4: blocked record linkage.

Work is done on *variants* (distinct tuples of block key + compared
values), not on records: records with identical tuples score identically
against everybody, so scoring variant pairs once and mapping the result
back is exact.  Variants and the similar values of each compared column are
written once in the checkpoint folder; similar values of a block meet on keys
that they must share, and string similarity (with the making of these keys
the only Python step) runs once per pair that lengths and characters do not
rule out.

Which columns must agree follows from the threshold and the columns that
are present on both sides.  Each smallest set of agreements that makes a match is
a join key, so variants meet only if they match: a value that a third of a
block has in common pairs nobody by itself, unless it alone is a match.
Linking (L4) lists no pairs at all: all variants of one key match all of a
partner key, and one link per pair of keys, one per member and one per
record of a variant yield the same connected components.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations, product
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.similarity import SWAP_MONTH_DAY_CREDIT, SWAP_MONTHS, date_feature, may_reach, string_similarity
from ..session import materialize
from .graph import connected_components, dense_ids
from .joins import CELL, chunks
from .signatures import candidate_pairs


def _ns_eq(cols: Sequence[str], l: str, r: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{l}{c}").eqNullSafe(F.col(f"{r}{c}")) for c in cols])


#: Pairs of similar values that a join may send to every task.
FEW_PAIRS = 100_000
#: Pairs of records that a task lists, about.
TASK_PAIRS = 1_000_000


def _spread(df: DataFrame) -> DataFrame:
    """``df`` for a join that sorts both sides: a written table of a few MB may hold gigabytes of repeated text."""
    return df.hint("merge")


def _similar_values(v: DataFrame, block: str, col: str, method: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Similar different values of ``col``: ordered pairs ``_va, _vb`` and, per block and value, the list of them.

    Values of a block meet on keys that every similar pair shares
    (``signatures``), and pairs that lengths and characters rule out are
    dropped before any Python runs; each unordered pair is compared once.
    """
    vals, _ = materialize(v.select(F.col(block).alias("_b"), F.col(col).alias("_v")).filter(F.col("_v").isNotNull()).distinct(), "values")
    near = candidate_pairs(vals, "_b", "_v", method, threshold).filter(may_reach(F.col("_va"), F.col("_vb"), method, threshold))
    near, _ = materialize(near, "near")
    pairs = near.select("_va", "_vb").distinct()
    pairs, _ = materialize(pairs.filter(string_similarity(F.col("_va"), F.col("_vb"), method) >= threshold), "similar")
    pairs = pairs if pairs.count() <= FEW_PAIRS else _spread(pairs)
    both = F.explode(F.array(F.struct("_va", "_vb"), F.struct(F.col("_vb").alias("_va"), F.col("_va").alias("_vb"))))
    lists = (near.join(pairs, ["_va", "_vb"]).select("_b", both.alias("_p")).groupBy("_b", F.col("_p._va").alias("_v"))
             .agg(F.collect_list("_p._vb").alias("_alts")))
    return pairs.select(both.alias("_p")).select("_p._va", "_p._vb"), lists


#: What a date agreement can be worth besides 1.
PARTIAL = SWAP_MONTH_DAY_CREDIT


def atom_sets(kinds: Sequence[str], present: Sequence[int], threshold: float) -> list[tuple[tuple[int, float], ...]]:
    """Smallest sets of agreements ``(column, worth)`` that make a match of a pair with these columns present.

    A pair matches if what its agreements are worth exceeds the threshold
    times the columns present on both sides; dropping agreements one by one
    while that holds leads to one of these sets, and a pair that has all of a
    set's agreements matches, whatever its other columns are.
    """
    def enough(atoms) -> bool:
        return bool(atoms) and sum(w for _, w in atoms) / len(present) > threshold

    out = []
    for k in range(1, len(present) + 1):
        for columns in combinations(present, k):
            for worth in product(*[(1.0, PARTIAL) if kinds[c] == "date" else (1.0,) for c in columns]):
                atoms = tuple(zip(columns, worth))
                if enough(atoms) and not any(enough(atoms[:i] + atoms[i + 1:]) for i in range(k)):
                    out.append(atoms)
    return out


def _day(y: Column, m: Column, d: Column) -> Column:
    return (y * 10000 + m * 100 + d).cast("string")


def _partial_days(c: str) -> Column:
    """Days that agree in part with a date: day and month swapped, months mixed up."""
    y, m, d = F.year(c), F.month(c), F.dayofmonth(c)
    days = [_day(y, d, m)] + [F.when(m == one, _day(y, F.lit(other), d)) for one, other, _ in SWAP_MONTHS]
    return F.array_except(F.array_distinct(F.array_compact(F.array(*days))), F.array(_day(y, m, d)))


def _extended(keys: Column, values: Column) -> Column:
    """Each key with each of the values at its end."""
    return F.flatten(F.transform(keys, lambda k: F.transform(values, lambda x: F.concat(k, F.array(x)))))


def keyed_variants(v: DataFrame, block: str, comparisons: Mapping[str, str], lists: Mapping[str, DataFrame], threshold: float) -> DataFrame:
    """``_rep, _key, _partners``: the keys of each variant, and the keys of those it matches.

    A key is a set of agreements, the columns that are present, the block and
    the values of the set's columns.  A variant has one for each set it may
    match by; its partners are the keys of variants whose values agree with
    its own (equal, similar or partly agreeing, as the set says), one for
    each list of columns that the other may have.  Two variants match if and
    only if one has the other's key as a partner.
    """
    names, kinds = list(comparisons), list(comparisons.values())
    n = len(names)
    for i, (c, kind) in enumerate(comparisons.items()):
        if kind == "string":
            near = lists[c].select(F.col("_b").alias("_nb"), F.col("_v").alias("_nv"), F.col("_alts").alias(f"_near{i}"))
            v = v.join(near, (F.col(block) == F.col("_nb")) & (F.col(c) == F.col("_nv")), "left").drop("_nb", "_nv")
    own = [F.col(c).cast("string") if kind == "string" else _day(F.year(c), F.month(c), F.dayofmonth(c)) for c, kind in comparisons.items()]
    v = v.select("_rep", F.col(block).cast("string").alias("_blk"), *[o.alias(f"_x{i}") for i, o in enumerate(own)],
                 *[(F.array_compact(F.concat(F.array(o), F.coalesce(f"_near{i}", F.array().cast("array<string>")))) if kind == "string"
                    else F.array(o)).alias(f"_full{i}") for i, (o, kind) in enumerate(zip(own, kinds))],
                 *[_partial_days(c).alias(f"_part{i}") for i, (c, kind) in enumerate(comparisons.items()) if kind == "date"],
                 sum((F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(names)), F.lit(0)).alias("_has"))
    masks = range(1, 1 << n)
    columns = {m: [i for i in range(n) if m >> i & 1] for m in range(1 << n)}
    found: dict[tuple, set[tuple[int, int]]] = {}
    for mine in masks:
        for other in masks:
            if mine & other:
                for atoms in atom_sets(kinds, columns[mine & other], threshold):
                    found.setdefault(atoms, set()).add((mine, other))
    made = []
    for number, atoms in enumerate(found):
        pairs = found[atoms]
        head = [F.lit(str(number)), F.col("_has").cast("string"), F.col("_blk")]
        key = F.array(*head, *[F.col(f"_x{i}") for i, _ in atoms])
        others = F.array().cast("array<string>")
        for mine in {m for m, _ in pairs}:
            others = F.when(F.col("_has") == mine, F.array(*[F.lit(str(o)) for m, o in sorted(pairs) if m == mine])).otherwise(others)
        partners = F.transform(others, lambda o: F.array(F.lit(str(number)), o, F.col("_blk")))
        for i, worth in atoms:
            partners = _extended(partners, F.col(f"_full{i}" if worth == 1.0 else f"_part{i}"))
        made.append(F.when(F.col("_has").isin(sorted({m for m, _ in pairs})), F.struct(key.alias("_key"), partners.alias("_partners"))))
    if not made:
        return v.select("_rep", F.array(F.lit("")).alias("_key"), F.array(F.array(F.lit(""))).alias("_partners")).limit(0)
    return v.select("_rep", F.explode(F.array_compact(F.array(*made))).alias("_k")).select("_rep", "_k._key", "_k._partners")


def _matching_variants(keyed: DataFrame) -> DataFrame:
    """Pairs ``(a__rep <= b__rep)`` of matching variants, each with itself included."""
    a = keyed.select(F.col("_rep").alias("_ra"), F.explode("_partners").alias("_partner"))
    met = a.join(_spread(keyed.select(F.col("_rep").alias("_rb"), "_key")), F.col("_partner") == F.col("_key"))
    return met.select(F.least("_ra", "_rb").alias("a__rep"), F.greatest("_ra", "_rb").alias("b__rep")).distinct()


def _matching_stars(keyed: DataFrame) -> DataFrame:
    """Edges whose components are those of all matching pairs, without listing these.

    All variants of one key match all of a partner key.  So it suffices to
    link one variant of each key to one of each partner key, and all variants
    of a key that has a partner (itself or another) to that one.
    """
    keyed, _ = materialize(keyed, "keys")
    groups = keyed.groupBy("_key").agg(F.min("_rep").alias("_head"), F.any_value("_partners").alias("_partners"))
    groups, _ = materialize(groups, "keygroups")
    a = groups.select("_head", F.col("_key").alias("_from"), F.explode("_partners").alias("_partner"))
    met = a.join(_spread(groups.select(F.col("_head").alias("_other"), "_key")), F.col("_partner") == F.col("_key"))
    met, _ = materialize(met.select("_head", "_from", "_other", "_key"), "partners")
    linked = (met.select(F.col("_from").alias("_key"), "_head").unionByName(met.select("_key", F.col("_other").alias("_head")))).distinct()
    stars = keyed.select("_rep", "_key").join(_spread(linked), "_key").select(F.col("_rep").alias("src"), F.col("_head").alias("dst"))
    return (met.select(F.col("_head").alias("src"), F.col("_other").alias("dst")).unionByName(stars)
               .filter(F.col("src") != F.col("dst")).distinct())


def _variants(df: DataFrame, block: str, comparisons: Mapping[str, str], id_col: str | None, numbered: bool = False) -> DataFrame:
    """Distinct tuples of block and compared columns (with the smallest id as ``_rep``), written once.

    ``numbered`` adds a number ``_no`` and the records ``_n`` of each.
    """
    for c, kind in comparisons.items():
        if kind not in ("string", "date"):
            raise ValueError(f"unknown comparison {kind!r} for {c}")
    cols = [block, *comparisons]
    base = df.filter(F.col(block).isNotNull())
    v = base.select(*cols).distinct() if id_col is None else base.groupBy(*cols).agg(F.min(id_col).alias("_rep"))
    if numbered:
        v = base.groupBy(*cols).agg(F.min(id_col).alias("_rep"), F.count(F.lit(1)).alias("_n")).withColumn("_no", F.monotonically_increasing_id())
    return materialize(v, "variants")[0]


def _similar(v: DataFrame, block: str, comparisons: Mapping[str, str], method: str, threshold: float) -> dict[str, tuple[DataFrame, DataFrame]]:
    return {c: _similar_values(v, block, c, method, threshold) for c, kind in comparisons.items() if kind == "string"}


def variant_pairs(df: DataFrame, block: str, comparisons: Mapping[str, str],
                  match_threshold: float = codes.MATCH_THRESHOLD,
                  string_method: str = "jarowinkler",
                  string_threshold: float = codes.STRING_THRESHOLD,
                  id_col: str | None = None, prune: bool = False) -> DataFrame:
    """Scored pairs of distinct variants inside each block (a <= b, self pairs kept).

    Columns: ``a_<c>``, ``b_<c>`` for the block and compared columns, one
    feature column per compared column, ``mean`` and ``match``.  With
    ``id_col`` every variant carries its smallest record id (``a__rep``,
    ``b__rep``) and pairs are oriented by it.  ``prune=True`` (needs
    ``id_col`` and a threshold >= 0) makes and scores the matching pairs
    only; otherwise all pairs of a block.
    """
    return _scored(_variants(df, block, comparisons, id_col), block, comparisons, match_threshold, string_method, string_threshold,
                   id_col is not None, prune)


def _scored(v: DataFrame, block: str, comparisons: Mapping[str, str], match_threshold: float, string_method: str,
            string_threshold: float, with_rep: bool, prune: bool) -> DataFrame:
    vcols = v.columns
    found = _similar(v, block, comparisons, string_method, string_threshold)
    similar = {c: pairs for c, (pairs, _) in found.items()}
    a = v.select(*[F.col(c).alias(f"a_{c}") for c in vcols])
    b = v.select(*[F.col(c).alias(f"b_{c}") for c in vcols])
    if prune and with_rep and match_threshold >= 0:
        keyed = keyed_variants(v, block, comparisons, {c: lists for c, (_, lists) in found.items()}, match_threshold)
        pairs = _matching_variants(materialize(keyed, "keys")[0]).join(_spread(a), "a__rep").join(_spread(b), "b__rep")
    else:
        if with_rep:
            orient = F.col("a__rep") <= F.col("b__rep")
        else:
            orient = F.struct(*[F.col(f"a_{c}") for c in comparisons]) <= F.struct(
                *[F.col(f"b_{c}") for c in comparisons])
        pairs = a.join(b, F.col(f"a_{block}") == F.col(f"b_{block}")).filter(orient)
    feats = []
    for c, kind in comparisons.items():
        ca, cb = F.col(f"a_{c}"), F.col(f"b_{c}")
        if kind == "string":
            sims = similar[c].withColumn("_close", F.lit(True))
            if similar[c].count() > 2 * FEW_PAIRS:
                sims = _spread(sims)
            pairs = pairs.join(sims, (ca == F.col("_va")) & (cb == F.col("_vb")), "left")
            pairs = pairs.withColumn(c, F.when(ca.isNull() | cb.isNull(), F.lit(None))
                                     .when((ca == cb) | F.col("_close"), F.lit(1.0)).otherwise(F.lit(0.0))) \
                         .drop("_va", "_vb", "_close")
        elif kind == "date":
            pairs = pairs.withColumn(c, date_feature(ca, cb))
        else:
            raise ValueError(f"unknown comparison {kind!r} for {c}")
        feats.append(c)
    n = reduce(lambda x, y: x + y, [F.col(c).isNotNull().cast("int") for c in feats])
    s = reduce(lambda x, y: x + y, [F.coalesce(F.col(c), F.lit(0.0)) for c in feats])
    mean = F.when(n > 0, s / n)
    return (pairs.withColumn("mean", mean)
                 .withColumn("match", F.coalesce(F.col("mean") > F.lit(match_threshold), F.lit(False))))


def block_and_match(df: DataFrame, id_col: str, block: str, comparisons: Mapping[str, str],
                    match_threshold: float = codes.MATCH_THRESHOLD,
                    string_method: str = "jarowinkler",
                    string_threshold: float = codes.STRING_THRESHOLD,
                    keep: str = "matches", cell: int = CELL) -> DataFrame:
    """L1: record pairs ``(id_a < id_b)`` of one block with their features.

    ``keep="matches"`` (default) returns the matching pairs only, which is
    what linking consumes; ``keep="all"`` returns every candidate pair of
    the block (quadratic in the block size, as in the reference).
    """
    cols = [block, *comparisons]
    # ids that repeat may be the smallest of several variants, so variants are numbered
    v = _variants(df, block, comparisons, id_col, numbered=True)
    vp = _scored(v, block, comparisons, match_threshold, string_method, string_threshold, True, keep == "matches")
    if keep == "matches":
        vp = vp.filter("match")
    vp = vp.filter((F.col("a__rep") < F.col("b__rep")) | (F.col("a__no") <= F.col("b__no")))
    rec = df.select(F.col(id_col).alias("_id"), *cols).filter(F.col(block).isNotNull() & F.col("_id").isNotNull())
    members, _ = materialize(rec.join(_spread(v.select("_no", "_n", *[F.col(c).alias(f"k_{c}") for c in cols])), _ns_eq(cols, "", "k_"))
                                .select("_id", "_no", "_n").distinct(), "members")
    out = _record_pairs(vp, members, list(comparisons), cell)
    # pairs of ids that have one variant each are listed once
    if members.groupBy("_id").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").isEmpty():
        return out
    return out.distinct()


def _record_pairs(vp: DataFrame, members: DataFrame, features: Sequence[str], cell: int) -> DataFrame:
    """Records ``_id`` of the variants ``_no`` of each pair: ``id_a < id_b``, features, mean and match.

    A variant of ``_n`` > ``cell`` records is dealt into chunks.  Each pair of
    variants, and of their chunks, is a cell with a number of its own on which
    its records meet, and there are as many tasks as the pairs of all cells need.
    """
    alike = F.col("a__no") == F.col("b__no")
    cells = vp.filter(~alike | (F.col("a__n") > 1))
    for side, at in (("a", "_p"), ("b", "_q")):
        cells = cells.withColumn(f"_c{side}", chunks(F.col(f"{side}__n"), cell)).withColumn(at, F.explode(F.sequence(F.lit(0), F.col(f"_c{side}") - 1)))
    cells = cells.filter(~alike | (F.col("_p") <= F.col("_q"))).select(
        F.monotonically_increasing_id().alias("_cell"), "a__no", "_p", "b__no", "_q", (alike & (F.col("_p") == F.col("_q"))).alias("_self"),
        (F.col("a__n") / F.col("_ca") * F.col("b__n") / F.col("_cb")).alias("_pairs"), *features, "mean", "match")
    cells, _ = materialize(cells, "cells")
    tasks = max(1, math.ceil((cells.agg(F.sum("_pairs")).first()[0] or 0) / TASK_PAIRS))
    dealt = members.withColumn("_m", F.pmod(F.xxhash64("_id"), chunks(F.col("_n"), cell)).cast("int"))
    a = dealt.select(F.col("_no").alias("a__no"), F.col("_m").alias("_p"), F.col("_id").alias("_a"))
    b = dealt.select(F.col("_no").alias("b__no"), F.col("_m").alias("_q"), F.col("_id").alias("_b"))
    x = cells.select("_cell", "_self", "a__no", "_p", *features, "mean", "match").join(_spread(a), ["a__no", "_p"]).drop("a__no", "_p")
    y = cells.select("_cell", "b__no", "_q").join(_spread(b), ["b__no", "_q"]).select("_cell", "_b")
    met = x.repartition(tasks, "_cell").join(_spread(y.repartition(tasks, "_cell")), "_cell")
    return (met.filter(F.when(F.col("_self"), F.col("_a") < F.col("_b")).otherwise(F.col("_a") != F.col("_b")))
               .select(F.least("_a", "_b").alias("id_a"), F.greatest("_a", "_b").alias("id_b"), *features, "mean", "match"))


def match_edges(df: DataFrame, id_col: str, block: str, comparisons: Mapping[str, str],
                match_threshold: float = codes.MATCH_THRESHOLD,
                string_method: str = "jarowinkler",
                string_threshold: float = codes.STRING_THRESHOLD) -> DataFrame:
    """Edges ``(src, dst)`` whose components equal those of L1's match graph.

    A matching pair of different variants links their representatives; a
    variant that matches itself (some compared value present) links each
    of its records to its representative.  No record pair is listed.
    """
    cols = [block, *comparisons]
    v = _variants(df, block, comparisons, id_col)
    if match_threshold >= 0:
        found = _similar(v, block, comparisons, string_method, string_threshold)
        cross = _matching_stars(keyed_variants(v, block, comparisons, {c: lists for c, (_, lists) in found.items()}, match_threshold))
    else:
        pairs = variant_pairs(df, block, comparisons, match_threshold, string_method, string_threshold, id_col=id_col).filter("match")
        cross = pairs.filter(F.col("a__rep") != F.col("b__rep")).select(F.col("a__rep").alias("src"), F.col("b__rep").alias("dst"))
    # a variant matches itself if all its present columns, worth 1 each, exceed the threshold
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in comparisons])
    keep = v.filter(some & F.lit(match_threshold < 1)).select("_rep", *[F.col(c).alias(f"k_{c}") for c in cols])
    rec = df.select(F.col(id_col).alias("_id"), *cols).filter(F.col(block).isNotNull())
    members = rec.join(keep, _ns_eq(cols, "", "k_"))
    inner = members.filter(F.col("_id") != F.col("_rep")).select(F.col("_id").alias("src"), F.col("_rep").alias("dst"))
    return cross.unionByName(inner)


def link_records(df: DataFrame, id_col: str, order: Sequence[str], link_list: Sequence[Mapping],
                 match_threshold: float = codes.MATCH_THRESHOLD,
                 string_method: str = "jarowinkler",
                 string_threshold: float = codes.STRING_THRESHOLD,
                 out: str = "linkage_PID") -> DataFrame:
    """L4: one L1 pass per entry of ``link_list``, union of matches,
    connected components, then ids 1..k: linked groups first (by their
    earliest row in ``order``), then unlinked rows in ``order``.

    ``link_list`` entries: ``{"block_variable": col, "match_variables": {col: "string"|"date"}}``.
    ``id_col`` must identify rows.
    """
    edges = reduce(lambda a, b: a.unionByName(b), [
        match_edges(df, id_col, p["block_variable"], p["match_variables"], match_threshold,
                    string_method, string_threshold) for p in link_list])
    ids = df.select(F.col(id_col).alias("id"))
    comp = connected_components(edges, ids, node="id")
    rows = df.select(F.col(id_col).alias("id"), F.struct(*[F.col(c) for c in order]).alias("_o"))
    per = comp.join(rows, "id").groupBy("component").agg(
        F.min("_o").alias("_o"), F.count(F.lit(1)).alias("_size"))
    per = per.withColumn("_single", (F.col("_size") == 1).cast("int"))
    numbered = dense_ids(per, ["_single", "_o"], out=out).select("component", out)
    labels = comp.join(numbered, "component").select(F.col("id").alias(id_col), F.col(out).cast("long").alias(out))
    return df.join(labels, id_col, "left")
