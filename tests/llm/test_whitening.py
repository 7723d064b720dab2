"""Whitening against a dense eigensolver, exact integers and hand-made matrices."""
import numpy as np
import pytest
from cases import SF
from kinlink.llm import whitening as W

rng = np.random.default_rng(5)
SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, component string, i string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "a", "b", "c", "d") for i, v in rows], SCHEMA)


def expected(rows, k=4):
    kept = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    kept = [(i, v + [0] * (width - len(v))) for i, v in kept]
    fit = sorted({tuple(v) for _, v in kept})
    n = len(fit)
    sums = [sum(v[d] for v in fit) for d in range(width)]
    centred = np.array(fit, float) - np.array(sums) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors.T[::-1][:k]
    out = {}
    for i, v in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        out.setdefault(i, []).append((n, deviation, (np.array(v) - np.array(sums) / n) @ vectors.T / np.sqrt(values), values / np.trace(cov)))
    return out


def check(got, want):
    """Equal but for one sign a component."""
    rows = {}
    for r in got:
        rows.setdefault((r.vec_id, r.component), []).append(r)
    k = max(c for _, c in rows)
    assert {i for i, _ in rows} == set(want)
    signs = {}
    for (i, c), found in rows.items():
        assert len(found) == len(want[i])
        assert sorted(r.deviation for r in found) == sorted(w[1] for w in want[i])
        for r in found:
            w = next(w for w in want[i] if w[1] == r.deviation)
            assert r.n == w[0] and abs(r.explained / w[3][c - 1] - 1) < 1e-9 and r.identity_error < 1e-9
            assert abs(abs(r.whitened) - abs(w[2][c - 1])) < 1e-7
            if abs(r.whitened) > 1e-6:
                signs.setdefault(c, set()).add(r.whitened * w[2][c - 1] > 0)
    assert all(len(s) == 1 for s in signs.values()) and len(signs) == k


def test_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = W.whiten(table).collect()
    check(got, expected([(r.vec_id, r.embedding) for r in table.collect()]))
    assert {r.component for r in got} == {1, 2, 3, 4}


def test_awkward_rows(spark):
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]                      # copies
    rows += [(7, rows[3][1]), (7, rows[3][1]), (200, rows[5][1][:4]), (201, [])]    # repeated ids, short, empty
    rows += [(300, None), (301, [0.1, None, 0.2]), (302, [float("nan")] * 6), (303, [float("inf")] + [0.0] * 5)]
    rows += [(None, rows[1][1])]
    check(W.whiten(frame(spark, rows)).collect(), expected(rows))


def test_no_variance(spark):
    schema = [f.name for f in W.whiten(frame(spark, [])).schema]
    assert schema == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert W.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(9)])).count() == 0
    line = W.whiten(frame(spark, [(i, [i / 4, i / 2, 0.0]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and len(line) == 9            # one direction varies
    assert abs(line[0].explained - 1) < 1e-12


def test_large_numbers_are_exact_or_null(spark):
    rows = [(1, [2.0 ** 20, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])]
    got = {r.vec_id: r.deviation for r in W.whiten(frame(spark, rows)).collect()}
    assert got == {i: w[0][1] for i, w in expected(rows).items()}
    rows[0] = (1, [2.0 ** 40, 0.0])
    assert {r.deviation for r in W.whiten(frame(spark, rows)).filter("vec_id = 1").collect()} == {None}


@pytest.mark.parametrize("n", [1, 2, 3, 8, 64])
def test_eigenvectors(n):
    for spread in (lambda: rng.uniform(1, 9, n), lambda: np.ones(n), lambda: 10.0 ** rng.integers(-6, 6, n),
                   lambda: np.repeat([5.0, 1.0], [n // 2, n - n // 2]), lambda: 3 + rng.uniform(-1e-12, 1e-12, n)):
        wanted = np.sort(spread())[::-1]
        q, _ = np.linalg.qr(rng.normal(size=(n, n)))
        matrix = (q * wanted) @ q.T
        matrix = (matrix + matrix.T) / 2
        values, vectors = W.leading_components(matrix, 4)
        k = min(4, n)
        assert np.allclose(values, wanted[:k], rtol=0, atol=1e-12 * wanted[0] * n)
        assert np.allclose(vectors @ vectors.T, np.eye(k), atol=1e-9)
        assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-10 * wanted[0] * n)


def test_split_matrices():
    for matrix in (np.diag([3.0, 1.0, 3.0, 2.0, 3.0]), np.kron(np.eye(3), [[2.0, 1.0], [1.0, 2.0]]), np.zeros((4, 4)), np.zeros((0, 0))):
        values, vectors = W.leading_components(matrix, 4)
        assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-12)
        assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:len(values)], atol=1e-12)


def test_sturm_counts():
    d, e = rng.normal(size=30), rng.normal(size=29)
    exact = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = rng.normal(size=50) * 3
    assert (W.sturm_count(d, e, at) == (exact < at[:, None]).sum(axis=1)).all()
