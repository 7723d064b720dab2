"""The manifest against a plain hash tree in Python."""
import hashlib
import zlib
from collections import Counter

import duckdb
import pytest
from cases import DOCS, SF, awkward, frame
from kinlink.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    fields = [None if f is None else str(f).encode() for f in (doc_id, source, lang, n_chars, text)]
    return H("".join("-" if f is None else f"{len(f)}:{f.decode()}" for f in fields))


def levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        out.append(nodes)
    return out


def expected(rows):
    """Rows of ``doc_id, text, lang, source, n_chars``."""
    langs = {}
    for doc_id, text, lang, source, n_chars in rows:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
        langs.setdefault(lang, []).append(((doc_id is not None, doc_id), plain_leaf(doc_id, source, lang, n_chars, text),
                                           plain_leaf(doc_id, source, lang, n_chars + 1, text) if hit else None))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([leaf for _, leaf, _ in sorted(langs[x], key=lambda r: r[:2])]) for x in langs}
    top = levels([trees[x][-1][0] for x in order])
    out = []
    for at, lang in enumerate(order):
        for i, ((_, doc_id), leaf, changed) in enumerate(sorted(langs[lang], key=lambda r: r[:2])):
            proof, node = [], changed or leaf
            for tree, place in ((trees[lang], i), (top, at)):
                for level in tree[:-1]:
                    pair = level[place // 2 * 2:place // 2 * 2 + 2]
                    proof += [x for j, x in enumerate(pair) if j != place % 2]
                    pair[place % 2] = node
                    node, place = H(*pair), place // 2
            out.append((doc_id, leaf, trees[lang][-1][0], top[-1][0], H(*proof), node, node == top[-1][0]))
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_awkward_rows(spark, awkward):
    from cases import awkward as rows
    want = expected(rows())
    for digits in (1, 2, 8):
        assert rows_of(M.manifest(awkward, digits=digits)) == want


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 17])
def test_uneven_trees(spark, n):
    rows = [(i, f"text {i}", x, "s", i) for x in (None, "", "de", "én", "z") for i in range(n if x != "de" else 1)]
    assert rows_of(M.manifest(frame(spark, rows), digits=2)) == expected(rows)


def test_one_row_and_none(spark, empty):
    assert rows_of(M.manifest(frame(spark, [(21, "x", "en", "s", 1)]))) == expected([(21, "x", "en", "s", 1)])
    got = M.manifest(empty)
    assert got.count() == 0 and got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_equal_rows_and_null_ids(spark):
    rows = [(None, "a", "en", "s", 1)] * 9 + [(None, "b", None, None, None)] * 3 + [(5, "a", "en", "s", 1)] * 7
    assert rows_of(M.manifest(frame(spark, rows), digits=2)) == expected(rows)


def test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = rows_of(M.manifest(docs, digits=3))
    assert got == expected([tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    assert {verified for *_, verified in got} == {True, False}


def test_sql_on_awkward_rows():
    import pandas as pd
    con = duckdb.connect()
    rows = awkward()
    con.register("documents", pd.DataFrame(rows, columns=[f.name for f in DOCS]).astype({"doc_id": "Int64", "n_chars": "Int64"}))
    got = con.execute(f"SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, verified FROM ({M.duckdb_sql()})").fetchall()
    assert Counter(got) == expected(rows)


def test_no_join_of_proofs(spark):
    """Rounds are grouped, never joined, and a block's groupings share one exchange."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = M.ranked(M.leaves(docs)).select("lang", "m", "idx", M.F.struct(M.F.col("leaf").alias("h")).alias("node"))
    written, _ = M.materialize(rows, "test")
    plan = M.roll_block(written, 0, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and plan.count("Sort [") == 1
