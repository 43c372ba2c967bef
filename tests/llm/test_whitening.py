"""Whitening against plain linear algebra in doubles and exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from peoplelake.llm import whitening

DDL = "vec_id bigint, embedding array<float>, component string, x string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], DDL).repartition(3)


def integers(rows):
    good = [(i, x) for i, x in rows if x is not None and all(v is not None and math.isfinite(v) for v in x)]
    width = max((len(x) for _, x in good), default=0)
    return [(i, [math.floor(256 * float(np.float32(v))) for v in x] + [0] * (width - len(x))) for i, x in good]


def check(spark, rows, components=4):
    got = whitening.whiten(frame(spark, rows), components)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    used = integers(rows)
    fitted = [list(x) for x in {tuple(x) for _, x in used}]
    n, many = len(fitted), min(components, len(fitted[0]))
    sums = [sum(column) for column in zip(*fitted)]
    x = np.array(fitted, float)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(len(sums), -1))
    values, vectors = values[::-1], vectors[:, ::-1]
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, k) for i, _ in used for k in range(1, many + 1))
    deviations = {}
    for i, x in used:
        deviations.setdefault(i, set()).add(sum((n * a - s) ** 2 for a, s in zip(x, sums)))
    assert all(int(r["deviation"]) in deviations[r["vec_id"]] and r["n"] == n for r in got)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    for k in range(many):
        of_k = {r["vec_id"]: r for r in got if r["component"] == k + 1}
        assert all(abs(r["explained"] - values[k] / values.sum()) < 1e-9 for r in of_k.values())
        if values[k] < 1e-9 * values[0]:
            assert all(r["whitened"] is None for r in of_k.values())
        elif min(abs(values[k] - v) for j, v in enumerate(values) if j != k) > 1e-6 * values[0] if len(values) > 1 else True:
            want = {i: (np.array(x) - np.array(sums) / n) @ vectors[:, k] / values[k] ** 0.5 for i, x in used}
            sign = max(want, key=lambda i: abs(want[i]))
            sign = np.sign(want[sign] * of_k[sign]["whitened"])
            assert all(abs(want[i] * sign - of_k[i]["whitened"]) < 1e-8 for i in want)
    return got


def test_against_doubles(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((300, 9)) @ rng.standard_normal((9, 9)) * 0.2
    rows = [(i, v) for i, v in enumerate(base.tolist())]
    rows += [(i + 1000, rows[7][1]) for i in range(100)] + [(7, rows[7][1])]  # copies weigh once; a repeated row is returned twice
    rows += [(2000, None), (2001, [None] * 9), (2002, [float("nan")] + [0.1] * 8), (2003, [float("inf")]), (None, rows[3][1])]
    rows = [r for r in rows if r[0] is not None]
    got = check(spark, rows)
    assert len([r for r in got if r["vec_id"] == 7]) == 8 and not [r for r in got if r["vec_id"] >= 2000]


def test_short_vectors_and_flat_dimensions(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(rng.standard_normal()), float(rng.standard_normal()), 0.25]) for i in range(40)]
    rows += [(50, []), (51, [1.0]), (52, [0.5, 0.5])]
    check(spark, rows)
    check(spark, [(i, [i / 7]) for i in range(9)])
    flat = check(spark, [(i, [i / 7, 0.0, 2 * i / 7]) for i in range(1, 9)], components=2)
    assert {r["explained"] for r in flat if r["component"] == 2} != {None}


def test_equal_eigenvalues_give_a_basis(spark):
    corners = [(a, b, c) for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    got = whitening.whiten(frame(spark, [(i, list(v)) for i, v in enumerate(corners)])).collect()
    assert {r["component"] for r in got} == {1, 2, 3} and got[0]["identity_error"] < 1e-12
    assert all(abs(r["explained"] - 1 / 3) < 1e-12 for r in got)


def test_nothing_and_no_variance(spark):
    for rows in ([], [(1, None)], [(1, []), (2, [])]):
        got = whitening.whiten(frame(spark, rows))
        assert got.columns[0] == "vec_id" and got.count() == 0
    got = whitening.whiten(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [0.5, 0.5])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 2), (2, 1), (2, 2)]
    assert {(r["n"], int(r["deviation"]), r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(1, 0, None, None, 0.0)}


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(5)
    for size, large in ((1, 10), (2, 10**12), (6, 10**20), (7, 3)):
        x = [[int(v) * large for v in row] for row in rng.integers(-9, 9, (size + 2, size))]
        if size == 7:
            x = [[*row[:4], 0, 0, row[0]] for row in x]  # zero and dependent columns
        m = [[sum(r[i] * r[j] for r in x) for j in range(size)] for i in range(size)]
        found = whitening.characteristic_polynomial(spark, m)
        power, coefficient, want = [[Fraction(i == j) for j in range(size)] for i in range(size)], Fraction(1), [Fraction(1)]
        for k in range(1, size + 1):  # the method of Faddeev and Le Verrier
            product = [[sum(m[i][t] * power[t][j] for t in range(size)) for j in range(size)] for i in range(size)]
            coefficient = -sum(product[i][i] for i in range(size)) / k
            power = [[product[i][j] + (coefficient if i == j else 0) for j in range(size)] for i in range(size)]
            want.append(coefficient)
        assert found == want[::-1]


@pytest.mark.parametrize("roots", [[5, 5, 3, 0], [1, 0, 0], [10**30, 10**30 - 1, 2], [7], [0, 0]])
def test_roots(roots):
    polynomial = [1]
    for r in roots:
        polynomial = [a - r * b for a, b in zip([0, *polynomial], [*polynomial, 0])]
    found = whitening.largest_roots(polynomial, 3)
    assert len(found) == min(3, len(roots))
    assert all(abs(f - r) <= Fraction(r, 2**whitening.BITS) for f, r in zip(found, roots))
    assert whitening.roots_above(polynomial, 5, 1) == sum(r > 2.5 for r in roots)


def test_primes():
    found = whitening.primes_beyond(1 << 100)
    assert found[0] == 2**31 - 1 and len(found) == 4
    assert [n for n in range(60) if whitening.is_prime(n)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59]
