"""Embedding whitening against a plain version in whole numbers."""

from fractions import Fraction

import numpy as np
import pytest

from quill.llm import queries, whitening as W

SF = "/root/testdata/sf0.001"


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(parts)


def plain(vectors, k=4):
    """Distinct integer vectors, exact covariance, eigenvectors."""
    x = [tuple(int(np.floor(256 * float(np.float32(c)))) for c in v) for v in vectors]
    fit = sorted(set(x))
    n, dims = len(fit), len(fit[0])
    s = [sum(v[i] for v in fit) for i in range(dims)]
    cov = np.array([[float(sum((Fraction(v[i]) - Fraction(s[i], n)) * (v[j] - Fraction(s[j], n)) for v in fit) / n)
                     for j in range(dims)] for i in range(dims)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    w = (np.array(x, float) - np.array(s) / n) @ (u / np.sqrt(e))
    return n, [sum((n * a - b) ** 2 for a, b in zip(v, s)) for v in x], w, e / np.trace(cov)


def test_query(spark):
    got = queries.op13_embedding_whitening(spark, SF).orderBy("vec_id", "component").collect()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    dims = 12                                           # the plain covariance in fractions is slow
    n = len({tuple(np.floor(256 * np.array(r.embedding, float)).astype(int)) for r in rows})
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n}
    assert all(0 <= r.identity_error <= 1e-9 for r in got)
    x = np.floor(256 * np.array([r.embedding for r in rows], float)).astype(int)
    fit = np.unique(x, axis=0)
    c = fit - fit.mean(axis=0)
    e, u = np.linalg.eigh(c.T @ c / n)
    want = (x - fit.mean(axis=0)) @ (u[:, ::-1][:, :4] / np.sqrt(e[::-1][:4]))
    w = np.array([r.whitened for r in got]).reshape(-1, 4)
    for j in range(4):
        assert min(np.abs(w[:, j] - want[:, j]).max(), np.abs(w[:, j] + want[:, j]).max()) < 1e-8
    assert [r.deviation for r in got[::4]] == [sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, fit.sum(axis=0))) for v in x]
    assert np.allclose([r.explained for r in got[:4]], e[::-1][:4] / e.sum(), rtol=1e-9)
    part = spark.createDataFrame([(r.vec_id, r.embedding[:dims], 0) for r in rows[:60]], "vec_id long, embedding array<float>, label int")
    n, off, want, share = plain([r.embedding[:dims] for r in rows[:60]])
    own = W.whiten(part, W.fit_whitening(part)).orderBy("vec_id", "component").collect()
    assert [r.deviation for r in own[::4]] == off and np.allclose([r.explained for r in own[:4]], share, rtol=1e-9)
    assert np.allclose(np.abs([r.whitened for r in own]), np.abs(want.ravel()), atol=1e-8)


def test_polarisation_is_exact_far_from_zero(spark):
    """A spread of one step around 10^9: the covariance loses nothing."""
    rng = np.random.default_rng(0)
    step = rng.integers(-1, 2, (200, 5))
    codes = spark.createDataFrame([(bytearray(W.packed(v)),) for v in np.unique(step + 10 ** 9, axis=0)], "code binary")
    dims, n, sums = W.count_and_sums(codes)
    fit = np.unique(step, axis=0)
    c = [[Fraction(int(v)) - Fraction(int(t), n) for v, t in zip(row, fit.sum(axis=0))] for row in fit]
    want = [[float(sum(r[i] * r[j] for r in c) / n) for j in range(5)] for i in range(5)]
    assert (dims, n) == (5, len(fit))
    assert W.polarised_covariance(codes, dims, n, sums).tolist() == want


def test_pairs_of_squares():
    rng = np.random.default_rng(3)
    for top in (10, 1 << 40):
        x = rng.integers(-top, top, (7, 4))
        want = [sum(int(v[i]) ** 2 if i == j else (int(v[i]) + int(v[j])) ** 2 for v in x) for i, j in W.pair_numbers(4)]
        assert W.squared_sums(x) == want


def test_limbs_round_trip():
    for v in (0, 1, -1, 1 << 31, -(1 << 63), 12345678901234567890123456789, -(10 ** 40)):
        rows = [{"k": 3, "limb": a, "part": p} for _, a, p in W._limbs((3,), v)]

        class Row(dict):
            def __iter__(self):
                return iter(self.values())
        assert W._whole([Row(r) for r in rows], 1).get(3, 0) == v


HARD = [
    (1, None, 0), (2, [], 0), (3, [1.0, None, 2.0], 0), (4, [1.0, float("nan"), 0.0], 0), (5, [float("inf"), 0.0, 0.0], 0),
    (6, [1.0, 2.0], 0),                                 # too few dimensions
    (7, [0.5, -0.25, 1.0], 0), (7, [0.5, -0.25, 1.0], 0), (None, [0.5, -0.25, 1.0], None),
    (8, [0.1, 0.2, 0.3], 0), (9, [-0.7, 0.9, 0.0], 0), (10, [0.5001, -0.25, 1.0], 0),   # 10 equals 7 as integers
    (11, [0.3, 0.8, -0.4], 0),
]


@pytest.mark.parametrize("parts", [1, 5])
def test_hard_rows(spark, parts):
    df = table(spark, HARD, parts)
    out = W.whiten(df, W.fit_whitening(df)).collect()
    usable = [r for r in HARD if r[0] is None or r[0] >= 7]
    assert len(out) == 3 * len(usable) and {r.n for r in out} == {4}
    n, off, want, share = plain([r[1] for r in usable], 3)
    by_id = {(r.vec_id, r.component): r for r in out}
    for i, (d, _, _) in enumerate(usable):
        for c in (1, 2, 3):
            r = by_id[d, c]
            assert r.deviation == r.deviation_exact == off[i] and abs(r.explained - share[c - 1]) < 1e-12
            assert abs(abs(r.whitened) - abs(want[i][c - 1])) < 1e-9
    assert by_id[7, 1] == by_id[10, 1].__class__(**{**by_id[10, 1].asDict(), "vec_id": 7})
    clash = df.selectExpr("*", "'x' as code", "'x' as at", "'x' as pair", "'x' as n", "'x' as part")
    assert sorted(map(str, W.whiten(clash, W.fit_whitening(clash)).collect())) == sorted(map(str, out))


def test_empty_and_flat_tables(spark):
    none = table(spark, [])
    assert W.fit_whitening(none) is None and W.whiten(none, None).count() == 0
    only_null = table(spark, [(1, None, 0)])
    assert W.fit_whitening(only_null) is None and W.whiten(only_null, None).count() == 0
    flat = table(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])
    rows = W.whiten(flat, W.fit_whitening(flat)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows] == [(1, 0, 0.0, 0.0, 0.0)] * 4


def test_values_beyond_64_bits(spark):
    df = table(spark, [(1, [1e30, 1.0], 0), (2, [-1e30, 2.0], 0), (3, [0.0, 5.0], 0)])
    rows = {(r.vec_id, r.component): r for r in W.whiten(df, W.fit_whitening(df)).collect()}
    assert len(rows) == 6 and all(np.isfinite(r.whitened) for r in rows.values())
    assert rows[1, 1].deviation is None and rows[3, 1].identity_error < 1e-4
