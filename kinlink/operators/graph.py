"""Co-occurrence, connected components, dense ids, clustering.

Components never need the pair list of a group: linking every member of a
group (or of a time bucket) to the group's smallest member gives the same
components with one edge per row.  The component loop is the alternating
large-star / small-star algorithm (Kiveris et al., 2014) on an edge
DataFrame; each round is written as Parquet in the session's checkpoint
folder, so a lost executor only recomputes one round.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_materialized, ensure_checkpoint_dir, materialize
from ._time import delta_micros, epoch_micros
from .joins import CELL, TASK_ROWS, distinct_rows, group_pairs, proximity_pairs
from .proximity import BLOCK, MOST_COLUMNS, matrix_pairs

MAX_ROUNDS = 100
#: Vertices with fewer pairs are no hubs.
HUB_LEAST = 16
#: Edges a vertex from which the graph is contracted before the rounds.
DENSE = 4


# ---------------------------------------------------------------- G5 ------
def _with_least(pairs: DataFrame, hub: int) -> DataFrame:
    """``src, dst, m``: each pair with the smallest ``dst`` of its ``src``.

    A vertex with more than ``hub`` pairs has its minimum looked up where its
    pairs lie: there are fewer such vertices than pairs over ``hub``, which
    bounds the broadcast.  The others are joined, at most ``hub`` rows a vertex.
    """
    m = pairs.groupBy("src").agg(F.min("dst").alias("m"), F.count(F.lit(1)).alias("_n"))
    hubs = F.broadcast(m.filter(F.col("_n") > hub).select("src", "m"))
    rest = m.filter(F.col("_n") <= hub).select("src", "m")
    return pairs.join(hubs, "src").unionByName(pairs.join(hubs.select("src"), "src", "left_anti").join(rest, "src"))


def _large_star(e: DataFrame, hub: int) -> DataFrame:
    nb = e.select("src", "dst").unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    # duplicates are harmless here: small-star groups and de-duplicates
    return (_with_least(nb, hub).filter(F.col("dst") > F.col("src"))
            .select(F.col("dst").alias("src"), F.least("m", "src").alias("dst")))


def _small_star(e: DataFrame, hub: int) -> DataFrame:
    o = e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")) \
         .filter(F.col("src") != F.col("dst"))
    j = _with_least(o, hub)
    leaves = j.filter(F.col("dst") != F.col("m")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    centre = j.select("src", F.col("m").alias("dst"))
    return leaves.unionByName(centre).distinct()


def _is_star_forest(e: DataFrame) -> bool:
    roots = e.select(F.col("dst").alias("src")).distinct()
    deep = roots.join(e.select("src").distinct(), "src", "left_semi")
    multi = e.groupBy("src").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("src")
    return deep.unionByName(multi).isEmpty()


def _contracted(e: DataFrame) -> tuple[DataFrame, str]:
    """``id, root``: each vertex and a smaller one that it reaches, or itself.

    A vertex follows its smallest neighbour, and that one's, up to four in a
    row.  A component's smallest id stays what it is, and edges between roots
    join the same components, so only those are left to the rounds.
    """
    spark = e.sparkSession
    near = (e.select(F.explode(F.array(F.struct(F.col("src").alias("id"), F.col("dst").alias("to")),
                                       F.struct(F.col("dst").alias("id"), F.col("src").alias("to")))).alias("_s"))
             .groupBy("_s.id").agg(F.min("_s.to").alias("to")))
    step, path = materialize(near.select("id", F.least("id", "to").alias("root")), "cc")
    for _ in range(2):
        onward = step.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        nxt, npath = materialize(step.join(onward, "root").select("id", F.col("_next").alias("root")), "cc")
        drop_materialized(spark, path)
        step, path = nxt, npath
    return step, path


def _between_roots(e: DataFrame, step: DataFrame) -> DataFrame:
    """Edges between the roots of their ends."""
    for c in ("src", "dst"):
        e = e.join(step.select(F.col("id").alias(c), F.col("root").alias("_r")), c).drop(c).withColumnRenamed("_r", c)
    return (e.filter(F.col("src") != F.col("dst"))
             .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())


def connected_components(edges: DataFrame, nodes: DataFrame | None = None, src: str = "src",
                         dst: str = "dst", node: str = "id", max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``(id, component)`` where component is the smallest id it reaches.

    ``edges`` are undirected; ``nodes`` (optional, column ``node``) adds
    isolated vertices, which label themselves.  Rounds grow with the logarithm
    of the longest path; more than ``max_rounds`` is an error, never a partial
    result.  A graph of many edges a vertex is contracted first, so the
    rounds do not go through all edges time and again.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    e = (edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
              .filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
              .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
              .distinct())
    e, path = materialize(e, "cc")
    n, ends = e.agg(F.count(F.lit(1)), F.approx_count_distinct("src")).first()
    step = None
    if n > DENSE * ends:
        step, _ = _contracted(e)
        nxt, npath = materialize(_between_roots(e, step), "cc")
        drop_materialized(spark, path)
        e, path = nxt, npath
    # rounds never add edges, so at most some 2000 vertices are hubs in any of them
    hub = max(HUB_LEAST, e.count() // 1000)
    for _ in range(max_rounds):
        # small star goes through its edges three times
        large, lpath = materialize(_large_star(e, hub), "cc")
        nxt, npath = materialize(_small_star(large, hub), "cc")
        drop_materialized(spark, path)
        drop_materialized(spark, lpath)
        e, path = nxt, npath
        if _is_star_forest(e):
            break
    else:
        raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")
    labels = e.select(F.col("src").alias(node), F.col("dst").alias("component")).unionByName(
        e.select(F.col("dst").alias(node), F.col("dst").alias("component"))).distinct()
    if step is not None:
        roots = labels.select(F.col(node).alias("root"), "component")
        labels = step.join(roots, "root", "left").select(F.col("id").alias(node), F.coalesce("component", "root").alias("component"))
    if nodes is None:
        return labels
    allnodes = nodes.select(F.col(node)).filter(F.col(node).isNotNull()).distinct()
    return (allnodes.join(labels, node, "left")
                    .select(node, F.coalesce(F.col("component"), F.col(node)).alias("component")))


# ---------------------------------------------------------------- G6 ------
def dense_ids(df: DataFrame, order: Sequence, out: str = "dense_id", start: int = 1,
              num_partitions: int | None = None) -> DataFrame:
    """Consecutive ids ``start ..`` in ``order`` (which must be unique).

    Range-partition and sort on ``order``, read each row's position inside
    its partition from ``monotonically_increasing_id`` (partition index in
    the upper bits), and add the row counts of the earlier partitions.  The
    offset table has one row per partition, so broadcasting it is bounded.
    No single-partition window is involved.

    The tagged rows are written once with a reliable ``checkpoint()``: the
    counts and the rows must come from the same range partitioning, and
    two evaluations of a sampled range exchange over a shuffled input are
    not guaranteed to agree (nor is a recomputation after a lost executor).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # without an explicit count AQE may merge adjacent small ranges; the
    # merged partitions stay contiguous, so the order is kept
    ranged = (df.repartitionByRange(num_partitions, *cols) if num_partitions
              else df.repartitionByRange(*cols)).sortWithinPartitions(*cols)
    tagged = (ranged.withColumn("_mid", F.monotonically_increasing_id())
                    .withColumn("_part", F.shiftright(F.col("_mid"), 33))
                    .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))))
    tagged, _ = materialize(tagged, "ids")
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_part")
                  .withColumn(out, (F.col("_off") + F.col("_pos") + F.lit(start)).cast("long"))
                  .drop("_mid", "_part", "_pos", "_off"))


# ---------------------------------------------------------------- G1 ------
def group_co_occurrence(df: DataFrame, individual: str, group: str, cell: int = CELL,
                        task_rows: int = TASK_ROWS) -> DataFrame:
    """G1: for each pair of individuals (a < b), the number of groups they share.

    Ids count once per group; null groups and null ids are ignored.  The
    matrix is symmetric, so only the upper triangle is returned.  The
    result itself holds one row per sharing pair; groups of more than
    ``cell`` members are paired chunk by chunk, in tasks of about
    ``task_rows`` pairs whatever the session's number of partitions.
    """
    m = df.select(F.col(individual).alias("_i"), F.col(group).alias("_g")) \
          .filter(F.col("_i").isNotNull() & F.col("_g").isNotNull())
    return (group_pairs(distinct_rows(m, task_rows), cell, task_rows).groupBy(F.col("a").alias("id_a"), F.col("b").alias("id_b"))
             .agg(F.count(F.lit(1)).alias("n_shared")))


# ---------------------------------------------------------------- G2 ------
#: Places of a matrix that take the time of one listed pair.
PLACES = 256


def _outermost(rows: DataFrame, width: int) -> DataFrame:
    """Distinct ``_i, _column, _t`` without times that meet nobody else: of an individual's times within
    ``2 * width`` of each other, the first and the last are close to all that any of them is close to."""
    span = F.lit(min(2 * width + 1, 1 << 62))
    ends = rows.groupBy("_i", "_column", (F.col("_t") - F.pmod("_t", span)).alias("_s")).agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"))
    return ends.select("_i", "_column", F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_t"))


def time_co_occurrence(df: DataFrame, individual: str, time_vars: Sequence[str],
                       time_unit: str = "ns", time_delta=0, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """For each pair (a < b), the number of time columns in which some of
    their rows lie within ``time_delta`` units.  Same column only; null
    times never co-occur.

    Where pairs meet often, those of ``block`` individuals each are marked in
    matrices (``proximity``); few pairs are joined and counted.
    """
    dtypes = dict(df.dtypes)
    if len(time_vars) <= MOST_COLUMNS and dtypes[individual] in ("int", "bigint"):
        width = max(0, delta_micros(time_delta, time_unit))
        rows = reduce(lambda x, y: x.unionByName(y), [
            df.select(F.col(individual).alias("_i"), F.lit(i).cast("tinyint").alias("_column"), epoch_micros(F.col(tv), dtypes[tv]).alias("_t"))
            for i, tv in enumerate(time_vars)]).filter(F.col("_i").isNotNull() & F.col("_t").isNotNull())
        rows, path = materialize(_outermost(rows, width), "times")
        buckets = rows.groupBy("_column", F.floor(F.col("_t") / max(width, 1))).agg(F.count(F.lit(1)).alias("_n"))
        n, pairs = buckets.agg(F.sum("_n"), F.sum(F.col("_n").cast("double") * F.col("_n"))).first()
        individuals = rows.select("_i").distinct().count()
        # pairs that are listed are shuffled; places of matrices are only gone through, each far sooner than a listed pair
        if (pairs or 0) > 2 * (n or 0) and individuals * (individuals / 2 + (n or 0) / block) < PLACES * pairs:
            found = matrix_pairs(rows, individuals, width, block)
            drop_materialized(df.sparkSession, path)
            return found
        drop_materialized(df.sparkSession, path)
    per_col = []
    for i, tv in enumerate(time_vars):
        p = proximity_pairs(df, individual, tv, time_delta, time_unit, cell)
        per_col.append(p.select(F.col("a").alias("id_a"), F.col("b").alias("id_b"))
                        .distinct().withColumn("_tv", F.lit(i)))
    allp = reduce(lambda x, y: x.unionByName(y), per_col)
    return allp.groupBy("id_a", "id_b").agg(F.count(F.lit(1)).alias("n_shared"))


# ---------------------------------------------------------------- G3 ------
def _star_edges(members: DataFrame) -> DataFrame:
    """Edges from every member of a group to the group's smallest member, as often as it is listed."""
    m = members.filter(F.col("_i").isNotNull() & F.col("_g").isNotNull())
    rep = m.groupBy("_g").agg(F.min("_i").alias("_rep"))
    return m.join(rep, "_g").select(F.col("_i").alias("src"), F.col("_rep").alias("dst"))


def _time_edges(df: DataFrame, individual: str, tv: str, time_unit: str, time_delta) -> DataFrame:
    """Edges whose components equal those of the proximity graph of one time column.

    Rows in one bucket of width delta are all within delta, so a star per
    bucket suffices; the closest pair across neighbouring buckets is
    (max of b, min of b+1), so buckets b and b+1 are linked exactly when that
    gap is at most delta.  Linear in the rows.
    """
    dtype = dict(df.dtypes)[tv]
    width = delta_micros(time_delta, time_unit)
    base = df.select(F.col(individual).alias("_i"), epoch_micros(F.col(tv), dtype).alias("_t")) \
             .filter(F.col("_t").isNotNull() & F.col("_i").isNotNull())
    if width <= 0:
        return _star_edges(base.select("_i", F.col("_t").alias("_g")))
    b = base.withColumn("_g", F.floor(F.col("_t") / width))
    star = _star_edges(b.select("_i", "_g"))
    stats = b.groupBy("_g").agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"), F.min("_i").alias("_rep"))
    nxt = stats.select((F.col("_g") - 1).alias("_g"), F.col("_lo").alias("_nlo"), F.col("_rep").alias("_nrep"))
    bridge = (stats.join(nxt, "_g").filter(F.col("_nlo") - F.col("_hi") <= width)
                   .select(F.col("_rep").alias("src"), F.col("_nrep").alias("dst")))
    return star.unionByName(bridge)


def cluster(df: DataFrame, individual: str, order: Sequence[str], group_var: str | None = None,
            time_var: Sequence[str] | None = None, time_unit: str = "ns", time_delta=0,
            out: str = "cluster") -> DataFrame:
    """Connected components over shared groups and close times.

    Adds ``out`` to every row: 1..k numbered by the first appearance (in
    ``order``) of any member of the component.  Individuals without links
    get their own cluster.
    """
    ids = df.select(F.col(individual).alias("id")).filter(F.col("id").isNotNull())
    edge_sets = []
    if group_var is not None:
        edge_sets.append(_star_edges(df.select(F.col(individual).alias("_i"), F.col(group_var).alias("_g"))))
    for tv in (time_var or []):
        edge_sets.append(_time_edges(df, individual, tv, time_unit, time_delta))
    if edge_sets:
        edges = reduce(lambda a, b: a.unionByName(b), edge_sets)
        comp = connected_components(edges, ids, node="id")
    else:
        comp = ids.distinct().select("id", F.col("id").alias("component"))
    first = df.select(F.col(individual).alias("id"), F.struct(*[F.col(c) for c in order]).alias("_o")) \
              .filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("_o").alias("_o"))
    comp_first = comp.join(first, "id").groupBy("component").agg(F.min("_o").alias("_o"))
    numbered = dense_ids(comp_first, ["_o"], out=out).select("component", out)
    labels = comp.join(numbered, "component").select(F.col("id").alias(individual), out)
    return df.join(labels, individual, "left")


# ---------------------------------------------------------------- G4 / A13 -
def household_clusters(df: DataFrame, person: str, household: str,
                       cluster_col: str = "h_cluster", size_col: str = "h_cluster_ct") -> DataFrame:
    """Persons linked when they ever share a household; cluster id and size.

    Clusters are numbered by their smallest person id; the size counts
    persons.  Rows with a null person or household get no cluster.
    """
    members = df.select(F.col(person).alias("_i"), F.col(household).alias("_g")) \
                .filter(F.col("_i").isNotNull() & F.col("_g").isNotNull())
    persons = members.select(F.col("_i").alias("id")).distinct()
    comp = connected_components(_star_edges(members), persons, node="id")
    sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias(size_col))
    numbered = dense_ids(sizes, ["component"], out=cluster_col)
    labels = comp.join(numbered, "component").select(
        F.col("id").alias(person), F.col(cluster_col).cast("int").alias(cluster_col),
        F.col(size_col).cast("int").alias(size_col))
    return df.join(labels, person, "left")
