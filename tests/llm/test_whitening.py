"""Whitening against numpy's eigenvectors, polynomials against fractions."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest
from almanac.llm import queries as Q
from almanac.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def determinant(m):
    m, out = [[Fraction(c) for c in r] for r in m], Fraction(1)
    for k in range(len(m)):
        r = next((r for r in range(k, len(m)) if m[r][k]), None)
        if r is None:
            return Fraction(0)
        if r != k:
            m[k], m[r], out = m[r], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k])]
    return out


@pytest.mark.parametrize("d", [1, 2, 3, 6, 10])
def test_polynomial_equals_determinants(spark, d):
    rng = random.Random(d)
    x = [[rng.choice([0, 0, rng.randint(-10**6, 10**6)]) for _ in range(d)] for _ in range(d + 2)]
    m = [[sum(r[i] * r[j] for r in x) for j in range(d)] for i in range(d)]
    f = W.polynomial(spark, m)
    for t in range(-2, d):
        assert sum(c * t**k for k, c in enumerate(f)) == determinant([[t * (i == j) - m[i][j] for j in range(d)] for i in range(d)])


def test_polynomial_mod_of_any_matrix():
    rng = random.Random(4)
    p = W.primes(2)[1]
    assert all(p % q for q in range(2, 1000)) and W.primes(3)[0] == 2**31 - 1
    for d in range(1, 7):
        m = [[rng.choice([0, 0, 1, rng.randrange(p)]) for _ in range(d)] for _ in range(d)]
        f = W.polynomial_mod(np.array(m), p)
        for t in range(d + 1):
            assert sum(int(c) * t**k for k, c in enumerate(f)) % p == determinant([[t * (i == j) - m[i][j] for j in range(d)] for i in range(d)]) % p


def from_roots(roots):
    f = [1]
    for r in roots:
        f = [a - b for a, b in zip([0, *f], [*(c * r for c in f), 0])]
    return f


def test_roots_of_all_multiplicities():
    for roots in ([7, 5, 5, 5, 2, 2], [1], [3, 3], [10**9 + 1, 10**9, 4, 4], [9, 8, 7, 6, 5, 4, 3, 2, 1]):
        found, bits = W.largest_roots([0, 0, *from_roots(roots)], 20, sum(roots))
        assert [(Fraction(r, 2**bits), m) for r, m in found] == sorted(((Fraction(x), roots.count(x)) for x in set(roots)), reverse=True)
    assert W.largest_roots([0, 0, 1], 3, 5)[0] == []
    found, bits = W.largest_roots([1, -3, 1], 2, 3)                       # (3 +- sqrt 5) / 2
    assert all(abs(Fraction(r, 2**bits)**2 - 3 * Fraction(r, 2**bits) + 1) < Fraction(1, 2**(bits - 4)) for r, _ in found)
    close = [10**20 + 1, 2 * 10**20 + 1]                                  # roots 2**-67 apart: 1 + 1e-20, and 1
    f = [close[0], -close[1], 10**20]
    found, bits = W.largest_roots(f, 2, 3)
    assert abs(Fraction(found[0][0] - found[1][0], 2**bits) - Fraction(1, 10**20)) < Fraction(1, 2**100)


def test_components_of_repeated_and_missing_eigenvalues(spark):
    m = [[2, 1, 0, 0], [1, 2, 0, 0], [0, 0, 3, 0], [0, 0, 0, 0]]          # 3, 3, 1, 0
    values, vectors = W.components(spark, m, 4)
    assert np.allclose([float(v) for v in values], [3, 3, 1])
    u = np.array([[float(c) for c in v] for v in vectors])
    assert np.allclose(u @ u.T, np.eye(3), atol=1e-15) and np.allclose(np.array(m) @ u.T, u.T * [3, 3, 1], atol=1e-14)
    assert W.components(spark, [[0, 0], [0, 0]], 2) == ([], [])
    assert len(W.components(spark, m, 1)[0]) == 1


def plain(rows, count=16):
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float))
    fit = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(len(x[0]), -1))
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(count, int((values > 1e-9 * values[0]).sum()))
    z = (x - fit.mean(axis=0)) @ vectors[:, :keep] / np.sqrt(values[:keep])
    deviation = [sum((len(fit) * int(c) - int(s))**2 for c, s in zip(r, fit.sum(axis=0))) for r in x]
    return len(fit), deviation, z, values[:keep] / values.sum()


def compare(out, rows, count=16):
    n, deviation, z, share = plain(rows, count)
    by = {}
    for r in out:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, len(share) + 1)) and len({r.identity_error for r in out}) == 1
    assert 0 <= out[0].identity_error < 1e-9
    for c, part in by.items():
        part.sort(key=lambda r: (r.vec_id, r.deviation))
        order = sorted(range(len(rows)), key=lambda k: (rows[k][0], deviation[k]))
        assert [(r.vec_id, r.n, r.deviation) for r in part] == [(rows[k][0], n, deviation[k]) for k in order]
        got, want = np.array([r.whitened for r in part]), z[order, c - 1]
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
        assert math.isclose(part[0].explained, share[c - 1], rel_tol=1e-9)


def test_op11_equals_numpy_on_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in Q.table(spark, "/root/testdata/sf0.001", "embeddings").collect()]
    out = Q.op11_whitening(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == 16 * len(rows)
    compare(out, rows)


def test_repeats_count_once_and_broken_vectors_go(spark):
    rng = np.random.default_rng(1)
    good = [(k, rng.normal(size=5).astype(np.float32).tolist()) for k in range(30)]
    good += [(100, good[0][1])] * 40 + [(101, good[1][1])]
    bad = [(1, None), (2, [1.0, None, 2.0, 3.0, 4.0]), (3, [math.nan] * 5), (4, [math.inf, 0.0, 0.0, 0.0, 0.0]), (5, []), (6, [1.0, 2.0]), (7, [1e30, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in good + bad], SCHEMA + ", whitened double, d int")
    compare(W.whiten(df).collect(), good)
    compare(W.whiten(df, 2).collect(), good, 2)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.integers(-2**20, 2**20, 3) * (2.0**12 if k % 5 else 1.0)).tolist()) for k in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    fitted = W.distinct_vectors(df, df.embedding)
    n, s, p = W._exact_sums(fitted, 3)
    x = [[64 * int(c) for c in v] for _, v in rows]
    assert (n, s) == (20, [sum(r[i] for r in x) for i in range(3)])
    assert p == [[sum(r[i] * r[j] for r in x) for j in range(3)] for i in range(3)]
    assert all(r.deviation is None for r in W.whiten(df).collect())        # n x - S reaches 2**42: its square no long


def test_tables_without_spread_give_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert W.whiten(df).collect() == [] and W.whiten(df).columns[0] == "vec_id"
    line = [(k, [float(k), 2.0 * k, 1.0]) for k in range(4)]
    out = W.whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r.component for r in out} == {1} and abs(out[0].explained - 1) < 1e-12


def test_null_vectors_in_decimals():
    u = W.null_vectors([[2, 0], [0, 5]], Decimal(5), 1)[0]
    assert abs(abs(u[1]) - 1) < Decimal("1e-20") and abs(u[0]) < Decimal("1e-20")
