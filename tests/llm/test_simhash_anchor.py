"""Operator 2 against all pairs."""
from collections import defaultdict

import numpy as np
import pytest
import xxhash

import cases
from cases import SF
from kinlink.llm import queries, simhash_anchor as S


def plain_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, max_bits):
    label = list(range(len(prints)))
    p = np.array(prints, np.uint64)
    changed = True
    while changed:
        changed = False
        for i in range(len(p)):
            near = np.flatnonzero(np.bitwise_count(p ^ p[i]) <= max_bits)
            least = min(label[j] for j in near)
            for j in near:
                if label[j] != least:
                    label[j], changed = least, True
    return label


def expected(rows, k=4, bits=4):
    prints = [plain_fingerprint(t, k) for _, t, *_ in rows]
    label = plain_components(prints, bits)
    least = defaultdict(list)
    for (i, *_), c in zip(rows, label):
        if i is not None:
            least[c].append(i)
    return sorted(((i, f"{p:016x}", min(least[c], default=None)) for (i, *_), p, c in zip(rows, prints, label)), key=str)


def test_fingerprint():
    for text in ("", None, "One", "a b c", "a b c d", "a b c d e", "Ä ä Straße\x0bx y", cases.words(500, 3), "z " * 300):
        for k in (1, 4):
            assert S.fingerprint(text, k) == plain_fingerprint(text, k)


def test_codes_are_perfect():
    rng = np.random.default_rng(1)
    for _, code in S.blocks():
        values = rng.integers(0, 1 << code.bits, 500)
        place, anchor, excess = code.near(values, 0)
        assert (place == np.arange(500)).all() and not excess.any()     # one anchor within the radius
        words = [w for w in range(1 << code.bits) if code._remainder(w) == 0] if code.bits < 16 else None
        if words:
            assert len(words) == 1 << code.name_bits and len({w >> code.check for w in words}) == len(words)
            place, anchor, excess = code.near(values[:50], 2)
            want = [(i, w >> code.check, max(0, d - code.radius)) for i, v in enumerate(values[:50].tolist())
                    for w in words if (d := (w ^ v).bit_count()) <= code.radius + 2]
            assert sorted(zip(place.tolist(), anchor.tolist(), excess.tolist())) == sorted(want)


@pytest.mark.parametrize("fine", [False, True])
@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 5, 7])
def test_linked_prints_meet(bits, fine):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 64, 40 if fine else 200, dtype=np.uint64)
    other = base.copy()
    for i in range(len(other)):
        for b in rng.choice(64, bits, replace=False):
            other[i] ^= np.uint64(1 << int(b))
    prints = np.unique(np.concatenate([base, other]))
    at, of, home = S.replicas(prints, bits, fine)
    assert home.sum() == len(prints) * len(S.thresholds(bits, fine))
    got = {tuple(sorted(x)) for a in np.unique(at[home])
           for x in S.spanning_links(of[(at == a) & home], np.unique(of[at == a]), bits)}
    want = {tuple(sorted((int(x), int(y)))) for x in prints for y in prints if x < y and int(np.bitwise_count(x ^ y)) <= bits}
    assert got == want      # pairs apart from each other: every link is needed


def test_spanning_links_join_what_pairs_join():
    rng = np.random.default_rng(9)
    p = np.unique(np.concatenate([np.uint64(0xABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
                                  ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)), rng.integers(0, 1 << 64, 50, dtype=np.uint64)]))
    links = S.spanning_links(p, p, 4)
    assert len(links) < len(p)
    index = {int(x): i for i, x in enumerate(p)}
    parent = list(range(len(p)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[root(index[a])] = root(index[b])
    mine, want = [root(i) for i in range(len(p))], plain_components(p.tolist(), 4)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_small_cells_give_the_same_groups(spark):
    rng = np.random.default_rng(2)
    p = np.unique(np.uint64(77) ^ (np.uint64(1) << rng.integers(0, 64, 90).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 90).astype(np.uint64)))
    df = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "print long")
    got = S.links(df, 2, cell=8).collect()
    parent = {int(x): int(x) for x in p.view(np.int64)}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in got:
        parent[root(a)] = root(b)
    mine, want = [root(int(x)) for x in p.view(np.int64)], plain_components(p.tolist(), 2)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_awkward_rows(awkward):
    for fine in (False, True):
        got = sorted(map(tuple, S.simhash_groups(awkward, fine=fine).collect()), key=str)
        assert got == expected(cases.awkward())


def test_empty(empty):
    assert S.simhash_groups(empty).collect() == [] and S.keep_one(empty).collect() == []


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op2_simhash(spark, SF).collect()), key=str)
    assert got == expected(rows)


def test_keep_one(awkward):
    kept = S.keep_one(awkward)
    assert kept.columns == awkward.columns
    label = plain_components([plain_fingerprint(t, 4) for _, t, *_ in cases.awkward()], 4)
    want = [min(i for (i, *_), c in zip(cases.awkward(), label) if c == group and i is not None) for group in set(label)]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
