"""L1-L4 (fixture F14) and the similarity features."""

import datetime as dt
from collections import Counter

import pytest

from kinlink.functions.similarity import jaro_winkler
from kinlink.operators import linkage

LINK_LIST = [
    {"block_variable": "lname", "match_variables": {"fname": "string", "ssn_as_str": "string", "dob": "date"}},
    {"block_variable": "fname", "match_variables": {"lname": "string", "ssn_as_str": "string", "dob": "date"}},
    {"block_variable": "ssn_as_str", "match_variables": {"fname": "string", "lname": "string", "dob": "date"}},
]
BASE = dict(pid0=["PHA0_1", "HMIS0_1"], ssn_as_str=["123456789", "123456789"], lname=["QWERT", "QWERT"],
            fname=["QWERT", "QWERT"], dob=["1990-02-01", "1990-02-01"])
THIRD = dict(pid0="HMIS0_2")

CASES = [
    ("identical", {}, [1, 1], 0.5),
    ("lname differs", {"lname": ["ASDF", "QWERT"]}, [1, 1], 0.5),
    ("fname differs", {"fname": ["ASDF", "QWERT"]}, [1, 1], 0.5),
    ("ssn differs", {"ssn_as_str": ["123456789", "246801357"]}, [1, 1], 0.5),
    ("lname permuted", {"lname": ["QERWT", "QWERT"]}, [1, 1], 0.5),
    ("fname permuted", {"fname": ["QWERT", "QEWRT"]}, [1, 1], 0.5),
    ("dob day/month", {"fname": ["QWERT", "QEWRT"], "dob": ["1990-01-02", "1990-02-01"]}, [1, 1], 0.5),
    ("ssn missing", {"ssn_as_str": ["123456789", None], "lname": ["QWERT", "QEWRT"],
                     "dob": ["1990-01-02", "1990-01-02"]}, [1, 1], 0.5),
    ("third unrelated", {"third": dict(ssn_as_str="246801357", lname="ASDF", fname="ASDF", dob="1977-03-04")},
     [1, 1, 2], 0.5),
    ("third partial", {"third": dict(ssn_as_str="246801357", lname="ASDF", fname="QWERT", dob="1990-02-01")},
     [1, 1, 2], 0.5),
    ("low threshold", {"third": dict(ssn_as_str="123456789", lname="ASDF", fname="QWERT", dob="1990-02-01")},
     [1, 1, 1], 0.1),
]


def _frame(spark, change):
    cols = {k: list(v) for k, v in BASE.items()}
    for k, v in change.items():
        if k != "third":
            cols[k] = v
    recs = [tuple(cols[c][i] for c in ("pid0", "ssn_as_str", "lname", "fname", "dob")) for i in range(2)]
    if "third" in change:
        t = change["third"]
        recs.append(("HMIS0_2", t["ssn_as_str"], t["lname"], t["fname"], t["dob"]))
    recs = [(i, p, s, l, f, dt.datetime.strptime(d, "%Y-%m-%d")) for i, (p, s, l, f, d) in enumerate(recs)]
    return spark.createDataFrame(recs, "row int, pid0 string, ssn_as_str string, lname string, fname string, dob timestamp_ntz")


@pytest.mark.parametrize("name,change,expected,threshold", CASES, ids=[c[0] for c in CASES])
def test_link_records(spark, name, change, expected, threshold):  # F14
    df = _frame(spark, change)
    out = linkage.link_records(df, "row", ["row"], LINK_LIST, match_threshold=threshold)
    assert [r.linkage_PID for r in out.orderBy("row").collect()] == expected


def test_block_and_match_features(spark):  # L1
    df = _frame(spark, {"fname": ["QWERT", "QEWRT"], "dob": ["1990-01-02", "1990-02-01"]})
    allp = linkage.block_and_match(df, "row", "lname", LINK_LIST[0]["match_variables"], keep="all").collect()
    assert len(allp) == 1
    r = allp[0]
    assert (r.fname, r.ssn_as_str, r.dob) == (1.0, 1.0, 0.5)
    assert abs(r["mean"] - 2.5 / 3) < 1e-12 and r.match


def test_all_null_features_do_not_match(spark):  # mean of nothing is not a match
    recs = [(0, "X", None, None), (1, "X", None, None)]
    df = spark.createDataFrame(recs, "row int, blk string, a string, b string")
    out = linkage.block_and_match(df, "row", "blk", {"a": "string", "b": "string"}, keep="all").collect()
    assert len(out) == 1 and out[0]["mean"] is None and out[0].match is False
    linked = linkage.link_records(df, "row", ["row"], [{"block_variable": "blk",
                                                        "match_variables": {"a": "string", "b": "string"}}])
    assert sorted(r.linkage_PID for r in linked.collect()) == [1, 2]


def test_jaro_winkler_values():
    assert abs(jaro_winkler("QERWT", "QWERT") - 0.88) < 1e-9
    assert abs(jaro_winkler("MARTHA", "MARHTA") - 0.9611111111111111) < 1e-12
    assert jaro_winkler("", "a") == 0.0 and jaro_winkler("ab", "ab") == 1.0


def test_pruned_candidates_find_every_match(spark):  # exactness of positive-feature pruning
    import random
    rnd = random.Random(5)
    names = ["QWERT", "QERWT", "ASDF", "ASDG", "ZXCV", None]
    recs = []
    for i in range(160):
        dd = dt.datetime(1990, rnd.choice([1, 2, 6, 7, 9, 10]), rnd.choice([1, 2, 6, 7]))
        recs.append((i, rnd.choice(["B1", "B2", "B3"]), rnd.choice(names), rnd.choice(names),
                     None if rnd.random() < 0.2 else dd))
    df = spark.createDataFrame(recs, "row int, blk string, f string, l string, dob timestamp_ntz")
    comp = {"f": "string", "l": "string", "dob": "date"}
    for t in (0.0, 0.3, 0.5, 0.7):
        full = linkage.variant_pairs(df, "blk", comp, t, id_col="row", prune=False).filter("match")
        pruned = linkage.variant_pairs(df, "blk", comp, t, id_col="row", prune=True).filter("match")
        k = ["a__rep", "b__rep", "f", "l", "dob", "mean"]
        assert sorted(map(tuple, full.select(*k).collect())) == sorted(map(tuple, pruned.select(*k).collect()))


def _sharing(texts, method, threshold):
    """Pairs of texts that share a key, as the shorter and the longer one."""
    from kinlink.operators import signatures as S
    starts = S.bands(max(map(len, texts)))
    rules = S.plans(starts, method, threshold)
    begins = method == "jarowinkler" and threshold > 0.7
    count = Counter("".join(texts))
    rank = {c: i for i, (c, _) in enumerate(reversed(count.most_common()))}
    held = [{}, {}]
    for role in (0, 1):
        for t in texts:
            for k in S.keys_of(t, bool(role), starts, rules, rank, begins):
                held[role].setdefault(k, set()).add(t)
    return {frozenset((a, b)) for k, short in held[0].items() for a in short for b in held[1].get(k, ()) if a != b}


@pytest.mark.parametrize("threshold", [0.95, 0.85, 0.75, 0.7, 0.6, 0.3, 0.0])
def test_every_similar_pair_shares_a_key(threshold):  # L2, exact
    import random
    r = random.Random(int(threshold * 100))
    texts = {"", "a", "b", "ab", "ba"}
    for _ in range(90):
        t = "".join(r.choices("abcdé", k=r.randint(1, 14)))
        texts.add(t)
        for _ in range(3):
            u = list(t)
            for _ in range(r.randint(1, 3)):
                k = r.randrange(len(u) + 1)
                u[k:k + r.randint(0, 1)] = r.choices("abcdé", k=r.randint(0, 2))
            texts.add("".join(u))
        texts.add(t + "".join(r.choices("abcdé", k=r.randint(1, 20))))
    texts = sorted(texts)
    shared = _sharing(texts, "jarowinkler", threshold)
    for i, a in enumerate(texts):
        for b in texts[i + 1:]:
            if jaro_winkler(a, b) >= threshold or jaro_winkler(b, a) >= threshold:
                assert frozenset((a, b)) in shared, (a, b)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    some = texts[:250]
    shared = _sharing(some, "levenshtein", threshold)
    for i, a in enumerate(some):
        for b in some[i + 1:]:
            if 1 - edits(a, b) / max(len(a), len(b)) >= threshold:
                assert frozenset((a, b)) in shared, (a, b)


def test_keys_are_few_and_selective():  # names of common lengths
    import random

    from kinlink.operators import signatures as S
    r = random.Random(2)
    letters = "eeeeeaaaarrriiiooottnnsslcudpmhgbfywkvxzjq"
    names = sorted({"".join(r.choices(letters, k=r.randint(4, 11))) for _ in range(4000)})
    starts = S.bands(11)
    rules = S.plans(starts, "jarowinkler", 0.85)
    n = [len(S.keys_of(x, role, starts, rules, {}, True)) for x in names for role in (False, True)]
    assert sum(n) / len(n) <= 60
    assert len(_sharing(names, "jarowinkler", 0.85)) < len(names) ** 2 / 2 / 20


def test_hot_name_pairs_nobody(spark):  # L1, L4: 10^5 records of one block with one first name
    from pyspark.sql import functions as F
    n = 100_000
    df = spark.range(n).select(
        F.col("id").alias("row"), F.lit("SMITH").alias("lname"), F.lit("MARY").alias("fname"),
        F.format_string("%09d", F.col("id") * 7919 % 999_999_937).alias("ssn"),
        F.timestamp_seconds(F.col("id") * 86_400 * 11 % (86_400 * 365 * 90)).cast("date").alias("dob"))
    comparisons = {"fname": "string", "dob": "date"}
    v = linkage._variants(df, "lname", comparisons, "row")
    found = linkage._similar(v, "lname", comparisons, "jarowinkler", 0.85)
    keyed = linkage.keyed_variants(v, "lname", comparisons, {c: x for c, (_, x) in found.items()}, 0.5)
    assert keyed.count() <= 4 * v.count()
    matches = linkage._matching_variants(keyed)
    days = v.count()                                            # one variant a birth date
    swapped = matches.filter("a__rep <> b__rep").count()
    assert matches.count() == days + swapped and swapped < 3 * days      # swapped or mixed-up dates only
    edges = linkage.match_edges(df, "row", "lname", comparisons)
    assert edges.count() < 4 * n


def test_groups_link_as_all_pairs_do(spark):  # L4: stars of keys against the pairs themselves
    import random
    from kinlink.operators.graph import connected_components
    r = random.Random(9)
    names = ["QWERT", "QERWT", "ASDF", "ASDG", "ZXCV", None, None]
    recs = [(i, r.choice(["B1", "B2", "B3", None]), r.choice(names), r.choice(names),
             None if r.random() < 0.3 else dt.date(1990, r.choice([1, 2, 6, 7, 9, 10]), r.choice([1, 2, 6, 7]))) for i in range(70)]
    df = spark.createDataFrame(recs, "row int, blk string, f string, l string, dob date")
    comp = {"f": "string", "l": "string", "dob": "date"}
    for t in (0.0, 0.5, 1.0):
        pairs = linkage.block_and_match(df, "row", "blk", comp, t, keep="all").filter("match")
        want = connected_components(pairs.select(F_col("id_a", "src"), F_col("id_b", "dst")), df.select("row"), node="row")
        got = connected_components(linkage.match_edges(df, "row", "blk", comp, t), df.select("row"), node="row")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def F_col(name, alias):
    from pyspark.sql import functions as F
    return F.col(name).alias(alias)


def test_no_join_on_the_block_alone(spark):  # L2: values of a block meet on keys
    from kinlink.operators import signatures as S
    vals = spark.createDataFrame([("b", "MARY"), ("b", "MARIE")], "blk string, v string")
    plan = S.candidate_pairs(vals, "blk", "v", "jarowinkler", 0.85)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 1 and "_k1" in joins[0] and "_k2" in joins[0]


def test_atom_sets():  # which agreements make a match
    sets = linkage.atom_sets(["string", "string", "date"], [0, 1, 2], 0.5)
    assert sets == [((0, 1.0), (1, 1.0)), ((0, 1.0), (2, 1.0)), ((1, 1.0), (2, 1.0))]
    assert linkage.atom_sets(["string", "date"], [0, 1], 0.5) == [((0, 1.0), (1, 1.0)), ((0, 1.0), (1, 0.5))]
    assert linkage.atom_sets(["string", "string"], [1], 0.5) == [((1, 1.0),)]
    assert linkage.atom_sets(["date"], [0], 0.5) == [((0, 1.0),)]
    assert linkage.atom_sets(["string", "date"], [0, 1], 1.0) == []


def test_keys_of_few_values_are_not_broadcast(spark):  # F1 of round 3: a small file of values, gigabytes of keys
    from kinlink.operators.signatures import candidate_pairs
    vals = spark.createDataFrame([(b, t) for b in range(4) for t in ("QWERT", "QERWT", "ASDF")], "b int, v string")
    found = candidate_pairs(vals, "b", "v", "jarowinkler", 0.85)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(map(tuple, found.collect())) == [(b, "QERWT", "QWERT") for b in range(4)]


def test_records_of_a_variant_meet_in_cells(spark):  # F4 of round 3: tasks follow the pairs, no sort of all pairs
    recs = [(i, "X", "QWERT" if i % 3 else "QERWT") for i in range(30)]
    df = spark.createDataFrame(recs, "row int, blk string, f string")
    out = linkage.block_and_match(df, "row", "blk", {"f": "string"}, cell=4)
    got = [(r.id_a, r.id_b) for r in out.collect()]
    assert len(got) == 435 and set(got) == {(a, b) for a in range(30) for b in range(a + 1, 30)}
    assert "HashAggregate" not in out._jdf.queryExecution().sparkPlan().toString()
    # ids that repeat, with equal and with other values
    twice = df.unionByName(df).unionByName(spark.createDataFrame([(1, "X", "QERWT"), (2, "X", "ZZ"), (None, "X", "QERWT")], df.schema))
    again = linkage.block_and_match(twice, "row", "blk", {"f": "string"}, cell=4).collect()
    assert len(again) == 435 and {(r.id_a, r.id_b) for r in again} == set(got)
