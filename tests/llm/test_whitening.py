import math
from fractions import Fraction

import numpy as np
import pytest
from helpers import CLASHING

from tickforge.llm import whitening as wh


def vectors(spark, rows):
    full = [(i, None if v is None else [None if c is None else float(c) for c in v], *CLASHING) for i, v in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, " + ", ".join(f"`{c}` string" for c in CLASHING))


def table_of(df):
    rows = sorted(df.collect(), key=lambda r: (r.vec_id is not None, r.vec_id, r.component))
    return rows, np.array([r.whitened for r in rows])


def exact(x):
    """n, S and M in Python integers."""
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    return n, s, np.array([[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)], object)


def test_polynomial_of_integer_matrices(spark):
    rng = np.random.default_rng(2)
    for d in (1, 2, 3, 7, 12):
        b = rng.integers(-50, 50, (d, max(1, d - d // 3)))
        m = (b @ b.T).astype(object)
        got = wh.characteristic_polynomial(spark, m)
        # Faddeev and LeVerrier's recurrence in fractions.
        want, k = [Fraction(1)], np.array([[Fraction(int(i == j)) for j in range(d)] for i in range(d)], object)
        for step in range(1, d + 1):
            mk = m.dot(k)
            c = -sum(mk[i, i] for i in range(d)) / step
            want.append(c)
            k = mk + np.array([[c if i == j else 0 for j in range(d)] for i in range(d)], object)
        assert got == [int(c) for c in reversed(want)]


def test_zero_pivots_and_blocks():
    p = 2**31 - 1
    m = np.array([[2, 0, 0, 1], [0, 3, 0, 0], [0, 0, 3, 0], [1, 0, 0, 2]])
    want = np.round(np.poly(m)).astype(int).tolist()[::-1]
    assert wh.polynomial_modulo(m % p, p) == [c % p for c in want]


def test_roots_with_multiplicity():
    poly = [1]
    for r in (0, 3, 3, 3, 10, 10, 25):
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [wh.roots_beyond(poly, t) for t in (0, 2, 3, 9, 10, 24, 25)] == [6, 6, 3, 3, 1, 1, 0]
    s = wh.scale_of(54)
    assert wh.largest_roots(poly, 10, 54) == [(25 << s, 1), (10 << s, 2), (3 << s, 3)]
    assert wh.largest_roots(poly, 2, 54) == [(25 << s, 1), (10 << s, 2)]


def test_primes():
    assert [p for p in range(200) if wh._is_prime(p)] == [p for p in range(2, 200) if all(p % q for q in range(2, p))]
    ps = wh.primes_for(10**60)
    assert math.prod(ps) > 10**60 and max(ps) < 2**31 and len(set(ps)) == len(ps)


def test_whitened_equals_a_plain_decomposition(spark):
    rng = np.random.default_rng(5)
    raw = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(raw)]
    rows += rows[:20] + [(None, raw[0].tolist())]
    odd = [(900, None), (901, []), (902, [1.0] * 5), (903, [None] + [0.0] * 5), (904, [float("nan")] * 6), (905, [float("-inf")] + [0.0] * 5)]
    df = vectors(spark, rows + odd).repartition(3)
    got = wh.whitened(df, 4).collect()
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in rows]
    n, s, m = exact(x)
    values, units = np.linalg.eigh(m.astype(float) / n / n)
    values, units = values[::-1], units[:, ::-1]
    white = ((np.array(x) - np.array(s) / n) @ units[:, :4]) / np.sqrt(values[:4])
    assert len(got) == 4 * len(rows)
    want, sign = {}, {}
    for (i, _), w, r in zip(rows, white, x):
        want.setdefault(i, (w, sum((n * a - b) ** 2 for a, b in zip(r, s))))
    for r in got:
        w, deviation = want[r.vec_id]
        assert abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-8
        if abs(r.whitened) > 1e-3:
            sign.setdefault(r.component, set()).add(np.sign(r.whitened) == np.sign(w[r.component - 1]))
        assert (r.n, int(r.deviation)) == (n, deviation)
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12 and r.identity_error < 1e-9
    assert all(len(v) == 1 for v in sign.values())


@pytest.mark.parametrize("rows, count", [
    ([], 0), ([[0.5, 0.5]], 0), ([[0.5, 0.5]] * 9, 0),
    ([[float(i), 1.0, float(i)] for i in range(8)], 1),                                  # one direction, a constant entry
    ([[1.0, 0, 0], [-1.0, 0, 0], [0, 1.0, 0], [0, -1.0, 0], [0, 0, 1.0], [0, 0, -1.0]], 3),  # one eigenvalue, three times
    ([[1e300, 1.0], [-1e300, 2.0], [0.0, 2.0]], 2),                                       # held at 2**62
    ([[1e17, 1e17], [1e17 + 64, -1e17], [3.0, 4.0]], 2),
])
def test_odd_tables(spark, rows, count):
    got, white = table_of(wh.whitened(vectors(spark, list(enumerate(rows))).coalesce(2)))
    assert len(got) == count * len(rows)
    if count:
        x = [[max(-2**62, min(2**62, math.floor(64 * c))) for c in v] for v in rows]
        n, s, m = exact(x)
        w = white.reshape(n, count)
        assert np.abs(w.T @ w / n - w.mean(0)[:, None] * w.mean(0) - np.eye(count)).max() < 1e-9
        for v, r in zip(x, got[::count]):
            deviation = sum((n * a - b) ** 2 for a, b in zip(v, s))
            assert r.deviation is None if deviation >= 10**38 else int(r.deviation) == deviation


def test_sums_are_exact_and_do_not_depend_on_the_partitions(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.integers(-2**40, 2**40, (50, 3)) / 64)]
    x = [[math.floor(64 * c) for c in v] for _, v in rows]
    for parts in (1, 7):
        n, s, products = wh.moments(wh.usable(vectors(spark, rows).repartition(parts)))
        assert (n, s) == (50, [sum(r[j] for r in x) for j in range(3)])
        assert products.tolist() == [[sum(r[i] * r[j] for r in x) for j in range(3)] for i in range(3)]


def test_query(spark):
    got = wh.op11_whitening(spark, "/root/testdata/sf0.001").collect()
    n = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert len(got) == 32 * n and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    shares = {r.component: r.explained for r in got}
    assert sorted(shares.values(), reverse=True) == [shares[c] for c in range(1, 33)]
