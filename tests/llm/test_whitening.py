import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from vialis.llm import whitening
from vialis.llm.whitening import leading_components, polar_factor


def symmetric(n, values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [
    np.linspace(-3, 5, 12), 10.0 ** -np.arange(12), np.array([1e6] + [1.0] * 11), np.r_[np.ones(6), -np.ones(6)], np.array([2.0] * 12),
    np.r_[np.zeros(6), np.arange(1, 7)], np.r_[5.0, 5.0 + 1e-9, np.arange(10)]])
def test_components_are_eigenvectors(values):
    a = symmetric(len(values), values)
    a = (a + a.T) / 2
    for k in (1, 5, len(values)):
        found, v = leading_components(a, k)
        assert np.allclose(found, np.sort(values)[::-1][:k], atol=1e-12 * np.abs(values).max())
        assert np.allclose(v.T @ v, np.eye(k), atol=1e-12)
        assert np.abs(a @ v - v * found).max() < 1e-11 * np.abs(values).max()


def test_polar_factor_of_signs():
    values = np.array([3.0, 1e-7, -2.0, -1e-9])
    a = symmetric(4, values, 2)
    q = np.linalg.qr(np.random.default_rng(2).standard_normal((4, 4)))[0]
    assert np.allclose(polar_factor((a + a.T) / 2), (q * np.sign(values)) @ q.T, atol=1e-6)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 9, 0.5) for i, v in rows], "vec_id long, embedding array<float>, component int, n double")


def check(rows, got, k):
    kept = [(i, v) for i, v in rows if v and len(v) == 5 and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    n, d = len(x), 5
    sums = [sum(r[j] for r in x) for j in range(d)]
    deviations = sorted((i, sum((n * c - s) ** 2 for c, s in zip(r, sums))) for (i, _), r in zip(kept, x))
    assert sorted((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == deviations
    assert len(got) == n * k and {r["n"] for r in got} == {n}
    means = [Fraction(s, n) for s in sums]
    centred = np.array([[float(c - m) for c, m in zip(r, means)] for r in x])
    v = np.array([[float(sum((r[a] - means[a]) * (r[b] - means[b]) for r in x) / n) for b in range(d)] for a in range(d)])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    for c in range(k):
        mine = {r["vec_id"]: r for r in got if r["component"] == c + 1}
        z = centred @ vectors[:, c] / math.sqrt(values[c])
        found = np.array([mine[i]["whitened"] for i, _ in kept])
        assert np.allclose(found * np.sign(found @ z), z, atol=1e-8)
        assert all(abs(r["explained"] - values[c] / np.trace(v)) < 1e-9 for r in mine.values())
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitened_rows_equal_fractions(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(c) for c in r.standard_normal(5) * [3, 2, 1, 0.5, 0.2] + [0, 4, 0, -9, 0]]) for i in range(300)]
    rows += [(300, None), (301, []), (302, [None] * 5), (303, [math.nan] * 5), (304, [math.inf, 0.0, 0.0, 0.0, 0.0]), (305, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, rows).repartition(7))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, got.collect(), 5)
    assert [r["component"] for r in whitening.whiten(frame(spark, rows), components=2).filter("vec_id = 7").collect()] == [1, 2]


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (4, [3.0, -1.0]), (4, [0.0, 0.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == [(0, 1), (0, 1), (0, 2), (0, 2), (4, 1), (4, 1), (4, 2), (4, 2)]


def test_nothing_varies_and_nothing_there(spark):
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in same)
    flat = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert sorted((r["component"], r["whitened"] is None, r["explained"]) for r in flat) == [(1, False, 1.0)] * 2 + [(2, True, 0.0)] * 2
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_large_entries_stay_exact(spark):
    rows = [(i, [2.0**40 * (i + 1), 3.0 * i, -(2.0**33) * i]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("component = 1").collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    told = {i: sum((6 * c - s) ** 2 for c, s in zip(r, sums)) for (i, _), r in zip(rows, x)}
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: d if d < 2**63 else None for i, d in told.items()}
    assert abs(got[0]["identity_error"]) < 1e-6
