from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import exact_spectrum as spectrum
from millrace.llm import whitening


def characteristic(matrix):
    """Coefficients of det(x - matrix), constant first, by Faddeev and LeVerrier."""
    n = len(matrix)
    a = np.array(matrix, object).reshape(n, n)
    c, m = [1], np.zeros((n, n), object)
    for k in range(1, n + 1):
        m = a @ m + c[-1] * np.eye(n, dtype=int).astype(object)
        c.append(-sum((a @ m)[i, i] for i in range(n)) // k)
    return c[::-1]


def gram(n, size, seed=0, scale=1000):
    x = np.random.default_rng(seed).integers(-scale, scale, (n, size)).astype(object)
    return (x.T @ x).tolist()


AWKWARD = {
    "full": gram(30, 7),
    "low_rank": gram(3, 7),
    "diagonal": np.diag([5, 5, 5, 2, 2, 0, 0]).tolist(),
    "zero_pivots": [[4, 0, 0, 1], [0, 3, 0, 0], [0, 0, 3, 0], [1, 0, 0, 4]],
    "close": [[10**12, 1, 0], [1, 10**12, 0], [0, 0, 10**12 + 1]],
    "one": [[7]],
    "wide_range": [[10**30, 0], [0, 1]],
}


@pytest.mark.parametrize("name", AWKWARD)
def test_polynomial_roots_and_null_spaces(name):
    matrix = AWKWARD[name]
    size, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    primes = spectrum.primes_for(spectrum.coefficient_bound(matrix))
    p = spectrum.remaindered([(q, spectrum.polynomial_modulo(matrix, q).tolist()) for q in primes])
    assert p == characteristic(matrix)
    roots = spectrum.leading_roots(p, size, trace)
    values = [float(r) for r, m in roots for _ in range(m)]
    known = np.linalg.eigvalsh(np.array(matrix, float))[::-1]
    assert np.allclose(values, known[: len(values)], rtol=1e-9) and np.allclose(known[len(values) :], 0, atol=1e-9 * trace)
    columns = np.concatenate([spectrum.null_space(matrix, r, m) for r, m in roots], axis=1)
    assert np.allclose(columns.T @ columns, np.eye(len(values)), atol=1e-14)
    a = np.array([[Fraction(x) for x in row] for row in matrix])
    for (root, _), v in zip([(r, 0) for r, m in roots for _ in range(m)], columns.T):
        exact = np.array([Fraction(x) for x in v])
        left = a @ exact - Fraction(root) * exact
        assert max(abs(float(x)) for x in left) <= 1e-14 * trace


def test_roots_that_agree_in_many_digits_are_told_apart():
    p = [1]
    for root in (10**25, 10**25 + 1, 10**25 + 3, 10**25 + 3, 4):
        p = [a - root * b for a, b in zip([0, *p], [*p, 0])]
    assert [(round(r), m) for r, m in spectrum.leading_roots(p, 5, 4 * 10**25 + 50)] == [
        (10**25 + 3, 2), (10**25 + 1, 1), (10**25, 1), (4, 1),
    ]


def make(spark, rows, extra=False):
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>").repartition(3)
    if extra:
        from pyspark.sql import functions as F

        names = ("v", "size", "i", "j", "n", "component", "whitened", "limb0", "label")
        df = df.select("*", *(F.lit("own").alias(c) for c in names))
    return df


def check(rows, found, components=32):
    """Against exact sums and numpy's eigenvectors; the rows have one length."""
    x = np.array([[int(np.floor(64.0 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in rows], object)
    n, s = len(rows), x.sum(axis=0)
    dev = n * x - s
    scatter = (dev.T @ dev).astype(float) / n**3
    e, vectors = np.linalg.eigh(scatter)
    e, vectors = e[::-1], vectors[:, ::-1]
    rank = int((e > 1e-9 * e[0]).sum())
    width = min(components, rank)
    want = (dev.astype(float) / n) @ vectors[:, :width] / np.sqrt(e[:width])
    by = {}
    for r in found:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert len(found) == n * width
    sign = np.zeros(width)
    for (i, _), d, w in zip(rows, (dev * dev).sum(axis=1), want):
        held = by[(i, int(d))]
        assert sorted(held) == list(range(1, width + 1))
        for k in range(width):
            r = held[k + 1][0]
            if sign[k] == 0 and abs(w[k]) > 0.1:
                sign[k] = np.sign(r.whitened * w[k])
            assert abs(r.whitened - (sign[k] or np.sign(r.whitened * w[k])) * w[k]) < 1e-6
            assert (r.n, abs(r.explained - e[k] / e.sum()) < 1e-9 * r.explained + 1e-12) == (n, True)
            assert r.identity_error < 1e-9


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(40, 40))
    rows = [(i, (rng.normal(size=40) @ mix).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]  # a large group of copies
    bad = [(900, None), (901, []), (902, [float("nan")] * 40), (903, [float("inf")] + [0.0] * 39), (904, [None] * 40)]
    found = whitening.whiten(make(spark, rows + bad, extra=True)).collect()
    check(rows, found)


def test_low_rank_and_repeated_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(i // 2, [float(a), float(2 * a), float(b), 0.5]) for i, (a, b) in enumerate(rng.integers(-50, 50, (60, 2)))]
    found = whitening.whiten(make(spark, rows)).collect()
    assert {r.component for r in found} == {1, 2} and len(found) == 120
    assert all(abs(r.identity_error) < 1e-12 for r in found)


def test_lengths_apart_and_large_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [0.0, 1e30]), (3, [-1e30, 5.0]), (4, [1.0, 2.0, 3.0]), (5, [2.0, 2.0, 4.0]), (6, [7.0])]
    found = whitening.whiten(make(spark, rows)).collect()
    assert sorted((r.vec_id, r.n, r.component) for r in found) == [
        (1, 3, 1), (1, 3, 2), (2, 3, 1), (2, 3, 2), (3, 3, 1), (3, 3, 2), (4, 2, 1), (5, 2, 1),
    ]
    assert {r.deviation for r in found if r.n == 3} == {None} and {r.deviation for r in found if r.n == 2} == {64**2 * 2}
    assert all(r.identity_error < 1e-9 for r in found)


def test_products_do_not_round():
    rng = np.random.default_rng(3)
    for scale in (5, 2**30, 2**62):
        y = rng.integers(-scale, scale, (500, 3))
        assert (whitening.exact_products(y) == y.astype(object).T @ y.astype(object)).all()


def test_empty(spark):
    assert whitening.whiten(make(spark, [])).collect() == []
    assert whitening.whiten(make(spark, [(1, None), (2, [1.0]), (3, [1.0])])).collect() == []
