"""Operator 12, Merkle manifest of a dataset by nested-struct rollup.

Every row is a leaf, a hash of its fields.  Leaves of one language ascend by
id; a range-partitioned sort gives each its rank there.  The binary digits
of the rank are columns: blocks of ``2 ** digits`` leaves are dealt over the
tasks once, and the digit columns are grouped away one after the other,
lowest first, each time nesting the (at most two) child structs in a parent
struct with their hash.  These groupings stream over rows sorted once; none
shuffles.  Block roots are the leaves of the next round, up to one root a
language; these subroots, ordered by language, are rolled up in the same way.

On the way back a block's nested structs are turned into one row a leaf, with
its path of siblings, by nested ``transform`` and ``explode``; what lies
above the block comes with a row of the round before, grouped with the block.
No proof is joined.  Folding runs over that path from the leaf, tampered
where that is asked for.

A block holds ``2 ** digits`` leaves whatever the size of the table, of one
language or of a group of copies, and rounds grow with its logarithm.  Block
tables lie in the folder that ``spark.checkpoint.dir`` names and are each
computed once.  To the driver go the number of leaves of the largest
language and the number of languages.

Defined results: a null field is ``-`` in its leaf; a null language is a
language of its own, the first one.  Rows with a null id come first in their
language and are not tampered with; rows that share an id are ordered by
leaf, equal rows are leaves of their own.  Empty and long texts are fields
like others.  An empty table has no root and gives no rows.  Other columns,
whatever their names, are no part of a leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import dense_ids
from ..session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Digits of a block: 256 leaves.
DIGITS = 8
OUT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def h(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(values: dict[str, Column]) -> Column:
    """Hash of the fields in order, each with its length in bytes before it."""
    texts = [values[f].cast("string") for f in FIELDS]
    return h(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def leaves(docs: DataFrame, every: int = 7) -> DataFrame:
    """``lang, doc_id, leaf`` and ``changed``, the leaf after tampering, where it is another one."""
    plain = {f: F.col(f) for f in FIELDS}
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(every)) == 0
    more = leaf(plain | {"n_chars": F.col("n_chars").cast("long") + 1})
    return docs.select("lang", F.col("doc_id").cast("long").alias("doc_id"), leaf(plain).alias("leaf"),
                       F.when(hit & F.col("n_chars").isNotNull(), more).alias("changed"))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``idx``, the rank of a leaf in its language, and ``m``, the leaves of that language.

    Sorted ranges give each row its place in (range, language); the counts of
    these, one row each, give what lies before.  Equal rows are told apart by
    their place in the written table, so that many of them are cut into
    ranges as well.
    """
    rows, _ = materialize(rows, "leaves")
    order = [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("_at")]
    at = F.monotonically_increasing_id()
    ranges = rows.withColumn("_at", at).repartitionByRange(*order).sortWithinPartitions(*order)
    placed, _ = materialize(ranges.drop("_at").select("*", F.shiftright(at, 33).alias("_range"),
                                                      at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), "ranges")
    counts = placed.groupBy(F.col("lang").alias("_lang"), F.col("_range").alias("_r")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("_lang").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_lang", "_r", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_off"),
                            F.sum("_n").over(Window.partitionBy("_lang")).alias("m"))
    here = F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("_range") == F.col("_r"))
    return (placed.join(offsets, here).withColumn("idx", F.col("_place") + F.col("_off"))
            .drop("_lang", "_r", "_off", "_range", "_place"))


# ------------------------------------------------------------------ up --
def roll_block(nodes: DataFrame, level: int, digits: int) -> DataFrame:
    """``lang, m, block, node``: nodes of ``2 ** digits`` neighbours nested in one struct.

    ``nodes`` has ``lang, m, idx, node`` with ``node.h``; ``level`` is how many
    digits were grouped away before.  A level of one node is no level: its
    hash is passed on.
    """
    digit = [f"d{k}" for k in range(digits)]
    rows = nodes.select("lang", "m", F.shiftright("idx", digits).alias("block"),
                        *[F.shiftright("idx", k).bitwiseAND(F.lit(1)).alias(d) for k, d in enumerate(digit)], "node")
    rows = rows.repartition("lang", "block").sortWithinPartitions("lang", "m", "block", *reversed(digit))
    for k, d in enumerate(digit):
        rows = rows.groupBy("lang", "m", "block", *reversed(digit[k + 1:])).agg(
            F.first(F.when(F.col(d) == 0, F.col("node")), ignorenulls=True).alias("l"),
            F.first(F.when(F.col(d) == 1, F.col("node")), ignorenulls=True).alias("r"))
        left, right = F.col("l.h"), F.col("r.h")
        up = F.when(F.col("m") <= 2 ** (level + k), left).when(right.isNull(), h(left)).otherwise(h(left, right))
        rows = rows.select("lang", "m", "block", *reversed(digit[k + 1:]),
                           F.struct(up.alias("h"), F.array_compact(F.array("l", "r")).alias("kids")).alias("node"))
    return rows


def roll_up(nodes: DataFrame, most: int, digits: int) -> list[DataFrame]:
    """Block tables of all rounds; the last one has one row a language."""
    rounds = []
    while True:
        blocks, _ = materialize(roll_block(nodes, digits * len(rounds), digits), "blocks")
        rounds.append(blocks)
        if most <= 2 ** (digits * len(rounds)):
            return rounds
        nodes = blocks.select("lang", "m", F.col("block").alias("idx"),
                              F.struct(F.col("node.h").alias("h"), F.col("block").alias("idx")).alias("node"))


# ---------------------------------------------------------------- down --
def _paths(node: Column, m: Column, level: int, digits: int, above: Column, steps: list[Column]) -> Column:
    """Array of the leaves under ``node``, each with its steps from the leaf to the root.

    A step has the sibling's hash (null: none in this run) and whether it comes after.
    """
    if not digits:
        return F.array(F.struct(node.alias("leaf"), F.concat(F.array_compact(F.array(*steps)), above).alias("path")))
    kids = node["kids"]

    def each(kid: Column, i: Column) -> Column:
        step = F.when(m > 2 ** (level + digits - 1), F.struct(F.get(kids, 1 - i)["h"].alias("sibling"), (i == 0).alias("after")))
        return _paths(kid, m, level, digits - 1, above, [step, *steps])

    return F.flatten(F.transform(kids, each))


def roll_down(rounds: list[DataFrame], tops: DataFrame, digits: int) -> DataFrame:
    """``lang, leaf, path, subroot, root`` of every leaf.

    ``tops`` has ``lang, path, subroot, root``: what lies above a language.  A
    block and the row that tells what lies above it meet in one group.
    """
    for level in range(len(rounds) - 1, -1, -1):
        above = tops.withColumn("block", F.lit(0).cast("long")) if level == len(rounds) - 1 else (
            tops.select("lang", "path", "subroot", "root", F.col("leaf.idx").alias("block")))
        both = rounds[level].unionByName(above.select("lang", "block", "path", "subroot", "root"), allowMissingColumns=True)
        met = both.groupBy("lang", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("m", "node", "path", "subroot", "root")])
        under = _paths(F.col("node"), F.col("m"), digits * level, digits, F.col("path"), [])
        tops = met.select("lang", "subroot", "root", F.inline(under))
    return tops


def manifest(docs: DataFrame, every: int = 7, digits: int = DIGITS) -> DataFrame:
    """One row a document: leaf, subroot of its language, root, hash of its proof, and the
    root folded from the leaf (tampered with where ``every`` divides the CRC-32 of the id)."""
    spark = docs.sparkSession
    rows = ranked(leaves(docs, every))
    most = rows.agg(F.max("m")).first()[0]
    if not most:
        return spark.createDataFrame([], OUT)
    item = F.struct(F.col("leaf").alias("h"), "doc_id", "changed")
    rounds = roll_up(rows.select("lang", "m", "idx", item.alias("node")), most, digits)
    subroots = dense_ids(rounds[-1].select("lang", F.col("node.h").alias("h")), [F.col("lang").asc_nulls_first()], "idx", start=0)
    n = rounds[-1].count()
    # the languages are the leaves of one more tree, which has no language
    nodes = subroots.select(F.lit("").alias("lang"), F.lit(n).cast("long").alias("m"), "idx",
                            F.struct("h", "idx", F.col("lang").alias("name")).alias("node"))
    over = roll_up(nodes, n, digits)
    nothing = F.array().cast("array<struct<sibling:string,after:boolean>>")
    root = over[-1].select("lang", nothing.alias("path"), F.col("node.h").alias("subroot"), F.col("node.h").alias("root"))
    tops = roll_down(over, root, digits).select(F.col("leaf.name").alias("lang"), "path", F.col("leaf.h").alias("subroot"), "root")
    tops, _ = materialize(tops, "tops")
    found = roll_down(rounds, tops, digits)

    def fold(node: Column, step: Column) -> Column:
        other = step["sibling"]
        return F.when(other.isNull(), h(node)).when(step["after"], h(node, other)).otherwise(h(other, node))

    siblings = F.concat_ws("", F.transform("path", lambda s: s["sibling"]))
    folded = F.aggregate("path", F.coalesce("leaf.changed", "leaf.h"), fold)
    return (found.select(F.col("leaf.doc_id").alias("doc_id"), F.col("leaf.h").alias("leaf"), "subroot", "root",
                         F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


# ----------------------------------------------------------------- SQL --
def _sql_leaf(n_chars: str) -> str:
    parts = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in
             ("CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text")]
    return f"sha256({' || '.join(parts)})"


def _sql_steps(tree: str, at: str) -> str:
    """Steps of ``at`` rows through the levels of ``tree``: 'R' or 'L' and the sibling, or 'S' alone."""
    return f"""SELECT t.id, t.lvl, CASE WHEN s.h IS NULL THEN 'S' WHEN t.idx % 2 = 0 THEN 'R' || s.h ELSE 'L' || s.h END AS step
      FROM (SELECT a.id, u.key, u.lvl, u.idx FROM {at} a JOIN {tree} u
              ON u.key IS NOT DISTINCT FROM a.key AND u.m > 1 AND u.idx = a.idx >> u.lvl) t
      LEFT JOIN {tree} s ON s.key IS NOT DISTINCT FROM t.key AND s.lvl = t.lvl AND s.idx = xor(t.idx, 1)"""


def duckdb_sql() -> str:
    """The same manifest, level by level in two recursive queries."""
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(
        list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""
    up = "lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (m + 1) // 2 FROM {t} WHERE m > 1 GROUP BY key, lvl, idx // 2, m"
    return f"""
    WITH RECURSIVE leaves AS (
        SELECT row_number() OVER () AS id, doc_id, lang AS key, {_sql_leaf('n_chars')} AS leaf,
               CASE WHEN doc_id IS NOT NULL AND n_chars IS NOT NULL AND {crc} % 7 = 0 THEN {_sql_leaf('n_chars + 1')} END AS changed
        FROM documents),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY key) AS m
        FROM leaves),
    tree AS (
        SELECT key, 0 AS lvl, idx, leaf AS h, m FROM ranked
        UNION ALL SELECT key, {up.format(t='tree')}),
    subroots AS (
        SELECT key AS lang, h, row_number() OVER (ORDER BY key NULLS FIRST) - 1 AS idx, count(*) OVER () AS m FROM tree WHERE m = 1),
    top AS (
        SELECT 0 AS key, 0 AS lvl, idx, h, m FROM subroots
        UNION ALL SELECT key, {up.format(t='top')}),
    langs AS (SELECT 0 AS key, idx AS id, idx FROM subroots),
    low AS ({_sql_steps('tree', 'ranked')}),
    high AS ({_sql_steps('top', 'langs')}),
    steps AS (
        SELECT r.id, s.h AS subroot, (SELECT list(step ORDER BY lvl) FROM low WHERE low.id = r.id) AS below,
               (SELECT list(step ORDER BY lvl) FROM high WHERE high.id = s.idx) AS above
        FROM ranked r JOIN subroots s ON s.lang IS NOT DISTINCT FROM r.key),
    paths AS (SELECT id, subroot, list_concat(coalesce(below, []::VARCHAR[]), coalesce(above, []::VARCHAR[])) AS path FROM steps),
    folded AS (
        SELECT r.doc_id, r.leaf, p.subroot, (SELECT h FROM top WHERE m = 1) AS root,
               sha256(list_aggregate(list_prepend('', list_transform(path, lambda s: substr(s, 2))), 'string_agg', '')) AS proof_sha256,
               list_reduce(list_prepend(coalesce(r.changed, r.leaf), path), lambda a, s: CASE substr(s, 1, 1)
                   WHEN 'S' THEN sha256(a) WHEN 'R' THEN sha256(a || substr(s, 2)) ELSE sha256(substr(s, 2) || a) END) AS folded_root
        FROM ranked r JOIN paths p ON p.id = r.id)
    SELECT *, folded_root = root AS verified FROM folded
    """
