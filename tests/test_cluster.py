"""G1-G6 (fixtures F11-F13) and invariants against brute force."""

import datetime as dt
import random

import pytest

from kinlink.operators import graph
from kinlink.operators.joins import proximity_pairs

A, B, C = dt.datetime(2001, 1, 13), dt.datetime(2003, 6, 10), dt.datetime(1999, 6, 10)


def _frame(spark, persons, groups=None, t1=None, t2=None):
    n = len(persons)
    recs = [(i, persons[i], None if groups is None else groups[i], None if t1 is None else t1[i],
             None if t2 is None else t2[i]) for i in range(n)]
    return spark.createDataFrame(recs, "row int, person long, grp long, t1 timestamp_ntz, t2 timestamp_ntz")


def _clusters(df):
    return [r.cluster for r in df.orderBy("row").collect()]


def test_groups_co_occurrence(spark):  # F11
    df = _frame(spark, [1, 200, 3, 100, 1, 200, 3, 100], [1, 1, 2, 2, 1, 2, 1, 2])
    got = {(r.id_a, r.id_b): r.n_shared for r in graph.group_co_occurrence(df, "person", "grp").collect()}
    assert got == {(1, 200): 1, (1, 3): 1, (3, 200): 2, (100, 200): 1, (3, 100): 1}
    assert _clusters(graph.cluster(df, "person", ["row"], group_var="grp")) == [1] * 8
    df2 = _frame(spark, [1, 2, 3, 4, 1, 2, 3, 4], [1, 1, 3, 3, 1, 1, 3, 3])
    assert _clusters(graph.cluster(df2, "person", ["row"], group_var="grp")) == [1, 1, 2, 2] * 2


def test_time_co_occurrence(spark):  # F12
    df = _frame(spark, [1, 200, 3, 100, 1, 200, 3, 100], t1=[A, A, B, B] * 2, t2=[A, B, A, B] * 2)
    one = {(r.id_a, r.id_b): r.n_shared for r in graph.time_co_occurrence(df, "person", ["t1"]).collect()}
    assert one == {(1, 200): 1, (3, 100): 1}
    assert _clusters(graph.cluster(df, "person", ["row"], time_var=["t1"])) == [1, 1, 2, 2] * 2
    two = {(r.id_a, r.id_b): r.n_shared for r in graph.time_co_occurrence(df, "person", ["t1", "t2"]).collect()}
    assert two == {(1, 200): 1, (3, 100): 1, (1, 3): 1, (100, 200): 1}
    assert _clusters(graph.cluster(df, "person", ["row"], time_var=["t1", "t2"])) == [1] * 8


def test_group_and_time_with_nulls(spark):  # F13
    persons = [1, 200, 3, 100, 1, 200, 30, 1000]
    t1 = [A, A, C, C, A, A, B, B]
    df = _frame(spark, persons, [1, 1, 4, 5, 1, 1, 3, 3], t1=t1)
    exp = [1, 1, 2, 2, 1, 1, 3, 3]
    assert _clusters(graph.cluster(df, "person", ["row"], group_var="grp", time_var=["t1"])) == exp
    t1n = [None] + t1[1:]
    dfn = _frame(spark, persons, [1, 1, None, 5, 1, 1, 3, 3], t1=t1n)
    assert _clusters(graph.cluster(dfn, "person", ["row"], group_var="grp", time_var=["t1"])) == exp


def _union_find(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for n in nodes:
        comp.setdefault(find(n), []).append(n)
    return {n: min(members) for members in comp.values() for n in members}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_union_find(spark, seed):  # G5
    rnd = random.Random(seed)
    nodes = list(range(300))
    edges = [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(220)]
    # a long chain to force several rounds
    edges += [(i, i + 1) for i in range(150, 199)]
    e = spark.createDataFrame(edges, "src long, dst long")
    n = spark.createDataFrame([(x,) for x in nodes], "id long")
    got = {r.id: r.component for r in graph.connected_components(e, n).collect()}
    assert got == _union_find(nodes, edges)


@pytest.mark.parametrize("cell", [1, 3, 7])
def test_large_groups_in_cells(spark, cell):  # G1: one group holds a third of all rows
    rnd = random.Random(cell)
    recs = [(i, rnd.randint(0, 40) if i % 20 else None, 0 if i % 3 == 0 else rnd.randint(1, 25)) for i in range(240)]
    df = spark.createDataFrame(recs, "row int, person long, grp long")
    groups, want = {}, {}
    for _, p, g in recs:
        if p is not None:
            groups.setdefault(g, set()).add(p)
    for members in groups.values():
        for a in members:
            for b in members:
                if a < b:
                    want[a, b] = want.get((a, b), 0) + 1
    got = graph.group_co_occurrence(df, "person", "grp", cell).collect()
    assert len(got) == len(want) and {(r.id_a, r.id_b): r.n_shared for r in got} == want


@pytest.mark.parametrize("cell, delta", [(1, 4), (4, 4), (5, 0), (9, 30)])
def test_dense_times_in_cells(spark, cell, delta):  # J9: each pair of rows exactly once
    rnd = random.Random(cell)
    base = dt.datetime(1969, 12, 31, 23, 59)
    recs = {(rnd.randint(0, 30), base + dt.timedelta(seconds=7 if i % 3 == 0 else rnd.randint(0, 200))) for i in range(200)}
    recs |= {(None, base), (3, None)}
    df = spark.createDataFrame(sorted(recs, key=str), "person long, t1 timestamp_ntz")
    want = sorted((a, b) for a, ta in recs for b, tb in recs if a is not None and b is not None and a < b
                  and ta is not None and tb is not None and abs((ta - tb).total_seconds()) <= delta)
    assert sorted((r.a, r.b) for r in proximity_pairs(df, "person", "t1", delta, "s", cell).collect()) == want


@pytest.mark.parametrize("seed", [5, 6])
def test_time_buckets_match_all_pairs(spark, seed):  # J9 + G3 bucket shortcut
    rnd = random.Random(seed)
    base = dt.datetime(2020, 1, 1)
    recs = [(i, rnd.randint(0, 60), base + dt.timedelta(seconds=rnd.randint(0, 400)))
            for i in range(150)]
    delta = rnd.randint(1, 9)
    df = spark.createDataFrame(recs, "row int, person long, t1 timestamp_ntz")
    pairs = set()
    for _, pa, ta in recs:
        for _, pb, tb in recs:
            if pa != pb and abs((ta - tb).total_seconds()) <= delta:
                pairs.add((min(pa, pb), max(pa, pb)))
    got = {(r.id_a, r.id_b) for r in graph.time_co_occurrence(df, "person", ["t1"], "s", delta).collect()}
    assert got == pairs
    pp = {(r.a, r.b) for r in proximity_pairs(df, "person", "t1", delta, "s").collect()}
    assert {(min(a, b), max(a, b)) for a, b in pp} == pairs
    persons = sorted({p for _, p, _ in recs})
    uf = _union_find(persons, pairs)
    first = {}
    for row, p, _ in sorted(recs):
        first.setdefault(uf[p], row)
    order = {c: i + 1 for i, c in enumerate(sorted(first, key=first.get))}
    out = graph.cluster(df, "person", ["row"], time_var=["t1"], time_unit="s", time_delta=delta)
    assert {(r.row, r.cluster) for r in out.collect()} == {(row, order[uf[p]]) for row, p, _ in recs}


def test_dense_ids(spark):  # G6
    df = spark.range(0, 5000).selectExpr("id * 7 % 5003 AS k")
    got = graph.dense_ids(df, ["k"], num_partitions=7).collect()
    m = sorted((r.k, r.dense_id) for r in got)
    assert [d for _, d in m] == list(range(1, 5001))


def test_household_clusters(spark):  # G4, A13
    df = spark.createDataFrame([(5, "h1"), (7, "h1"), (9, "h2"), (7, "h3"), (11, "h3"), (20, None),
                                (None, "h9"), (30, "h4")], "linkage_PID long, hh_id string")
    got = {r.linkage_PID: (r.h_cluster, r.h_cluster_ct)
           for r in graph.household_clusters(df, "linkage_PID", "hh_id").collect()}
    assert got == {5: (1, 3), 7: (1, 3), 11: (1, 3), 9: (2, 1), 30: (3, 1), 20: (None, None),
                   None: (None, None)}


def test_dense_ids_after_shuffle(spark):  # G6 on a shuffled, pruned input stays consistent
    base = spark.range(0, 20000).selectExpr("id % 3001 AS a", "id % 7 AS b", "repeat('x', 50) AS pad")
    df = base.distinct()
    out = graph.dense_ids(df, ["a", "b"], out="n").select("a", "b", "n")
    got = sorted((r.a, r.b, r.n) for r in out.collect())
    assert [n for *_, n in got] == list(range(1, len(got) + 1))


def test_hub_components(spark):  # G5: a vertex that half of all edges meet, chains and stars hanging on it
    import random
    from kinlink.operators.graph import _with_least, connected_components
    r = random.Random(3)
    edges = [(0, i) for i in range(1, 3000)] + [(i, 10_000 + i) for i in range(1, 3000, 3)]
    edges += [(20_000 + i, 20_001 + i) for i in range(60)] + [(30_000, 30_000 + i) for i in range(1, 400)]
    edges += [(r.randint(40_000, 42_000), r.randint(40_000, 42_000)) for _ in range(1500)]
    ids = {v for e in edges for v in e}
    parent = {v: v for v in ids}

    def root(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    r.shuffle(edges)
    df = spark.createDataFrame([e if r.random() < 0.5 else e[::-1] for e in edges], "src long, dst long")
    got = {x.id: x.component for x in connected_components(df).collect()}
    assert got == {v: root(v) for a, b in edges if a != b for v in (a, b)}
    least = {}
    for a, b in df.collect():
        least[a] = min(b, least.get(a, b))
    for hub in (1, 16, 10_000):
        rows = _with_least(df, hub).collect()
        assert len(rows) == df.count() and all(x.m == least[x.src] for x in rows)


def test_frequent_meetings_are_marked_not_listed(spark):  # F2 of round 3
    import random
    from kinlink.operators.proximity import matrix_pairs
    rnd = random.Random(3)
    events = [(rnd.choice([None, *range(60)]), dt.datetime(2024, 1, 1, rnd.randrange(3), rnd.randrange(60), rnd.randrange(60)),
               rnd.choice([None, dt.datetime(2024, 1, 1, rnd.randrange(3))])) for _ in range(500)]
    want = {}
    for at in (1, 2):
        for a, b in {(min(x[0], y[0]), max(x[0], y[0])) for x in events for y in events
                     if None not in (x[0], y[0], x[at], y[at]) and x[0] != y[0] and abs((x[at] - y[at]).total_seconds()) <= 60}:
            want[a, b] = want.get((a, b), 0) + 1
    df = spark.createDataFrame(events, "person bigint, t1 timestamp_ntz, t2 timestamp_ntz")
    for block in (16, 4096):
        out = graph.time_co_occurrence(df, "person", ["t1", "t2"], "s", 60, block=block)
        got = [tuple(r) for r in out.collect()]
        assert {(a, b): n for a, b, n in got} == want and len(got) == len(want)
    # pairs are not shuffled: no aggregation after the marks
    assert "Aggregate" not in out._jdf.queryExecution().sparkPlan().toString()
    import pyspark.sql.functions as F
    long = df.select("person", F.explode(F.array(*[F.struct(F.lit(i).cast("tinyint").alias("_column"), F.unix_micros(F.col(c).cast("timestamp")).alias("_t"))
                                                   for i, c in enumerate(("t1", "t2"))])).alias("e")).select(F.col("person").alias("_i"), "e.*")
    rows = long.dropna().distinct()
    cut = matrix_pairs(rows, 60, 60_000_000, block=16, cell_rows=40).collect()
    assert {(r.id_a, r.id_b): r.n_shared for r in cut} == want and len(cut) == len(want)


def test_group_pairs_tasks_follow_the_pairs(spark):  # a task's rows and pairs do not grow with the table
    from kinlink.operators import joins
    rows = [(i, g) for g in range(40) for i in range(g, g + 9)]
    df = spark.createDataFrame(rows + rows[:50] + [(None, 1), (3, None)], "_i long, _g long")
    members = joins.distinct_rows(df.dropna(), 36)
    assert members.rdd.getNumPartitions() == 12 and members.count() == len(rows)    # 410 rows, 36 a task
    pairs = joins.group_pairs(members, task_rows=36)
    assert pairs.rdd.getNumPartitions() == 40                                        # 40 groups of 36 pairs
    want = sorted((a, b) for g in range(40) for a in range(g, g + 9) for b in range(a + 1, g + 9))
    assert sorted(map(tuple, pairs.collect())) == want
    assert sorted(map(tuple, joins.group_pairs(members, 4, 36).collect())) == want


def test_dense_graph_is_contracted(spark, monkeypatch):  # rounds do not go through all edges
    rnd = random.Random(3)
    edges = [(base + rnd.randint(0, 29), base + rnd.randint(0, 29)) for base in (100, 40, 0) for _ in range(400)] + [(None, 1), (9, 9)]
    df = spark.createDataFrame(edges, "src long, dst long")
    left, between = [], graph._between_roots

    def counted(e, step):
        out = between(e, step)
        left.append((e.count(), out.count()))
        return out

    monkeypatch.setattr(graph, "_between_roots", counted)
    nodes = spark.createDataFrame([(v,) for e in edges for v in e] + [(500,)], "id long")
    got = {r.id: r.component for r in graph.connected_components(df, nodes).collect()}
    want = {500: 500, 9: 9} | {v: v for e in edges for v in e if None not in e and e[0] != e[1]}
    while True:
        nxt = dict(want)
        for a, b in edges:
            if a in nxt and b in nxt:
                nxt[a] = nxt[b] = min(nxt[a], nxt[b])
        if nxt == want:
            break
        want = nxt
    assert got == want and all(few * 10 < many for many, few in left) and len(left) == 1


def test_rows_of_frequent_meetings_are_not_copied(spark):  # F1 of round 4
    import random

    import numpy as np
    from kinlink.operators import proximity
    rnd = random.Random(8)
    at = dt.datetime(1969, 12, 31, 23)
    events = [(rnd.choice([7, 7, 7, *range(40)]), at + dt.timedelta(seconds=rnd.randrange(7200))) for _ in range(700)]
    df = spark.createDataFrame(events, "person int, t timestamp_ntz")
    for seconds in (0, 5, 60, 100_000):
        want = {(min(x[0], y[0]), max(x[0], y[0])) for x in events for y in events
                if x[0] != y[0] and abs((x[1] - y[1]).total_seconds()) <= seconds}
        out = graph.time_co_occurrence(df, "person", ["t"], "s", seconds, block=4)
        got = [(r.id_a, r.id_b) for r in out.collect()]
        assert set(got) == want and len(got) == len(want)
        if seconds == 60:
            # each block is read for the others it meets; its rows are not shuffled once for each of them
            plan = out._jdf.queryExecution().sparkPlan().toString()
            assert "CartesianProduct" in plan and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    # the hot individual's block is several pieces
    want = {(min(x[0], y[0]), max(x[0], y[0])) for x in events for y in events if x[0] != y[0] and abs((x[1] - y[1]).total_seconds()) <= 60}
    rows = df.selectExpr("person as _i", "cast(0 as tinyint) as _column", "unix_micros(cast(t as timestamp)) as _t").distinct()
    cut = proximity.matrix_pairs(rows, 40, 60_000_000, block=4, cell_rows=60).collect()
    assert {(r.id_a, r.id_b): r.n_shared for r in cut} == {p: 1 for p in want} and len(cut) == len(want)
    # an individual's times: those between two others that are close to all of theirs are left out
    every_second = spark.range(-500, 500).selectExpr("1 as _i", "cast(0 as tinyint) as _column", "id * 1000000 as _t")
    assert graph._outermost(every_second, 30_000_000).count() <= 2 * (1000 // 60 + 2)
    # rectangles of many equal times and single close times are marked alike
    i, t = np.arange(600) % 50, np.arange(600) // 200 * 100
    one = proximity.unpack(proximity.pack(i, np.zeros(600, int), t))
    pairs = {(int(a), int(b)) for x, y, _ in proximity.met(one, one, True, 10) for a, b in zip(x, y)}
    assert pairs == {(a, b) for a in range(50) for b in range(a + 1, 50)}
