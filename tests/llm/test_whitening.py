import math
from fractions import Fraction

import numpy as np
import pytest

from feedwright.llm import whitening as wh
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("kind", ["random", "clustered", "repeated", "graded", "diagonal", "identity", "rank one", "single"])
def test_eigenvectors(kind):
    r = np.random.default_rng(4)
    m = 1 if kind == "single" else 40
    q = np.linalg.qr(r.standard_normal((m, m)))[0]
    values = {"random": r.uniform(0, 9, m), "clustered": 1 + 1e-9 * np.arange(m), "repeated": np.repeat([3.0, 2, 1, 0.5], m // 4),
              "graded": 10.0 ** -np.linspace(0, 12, m), "rank one": np.array([5.0] + [0.0] * (m - 1))}.get(kind, np.ones(m))
    a = np.diag(np.arange(m, 0, -1.0)) if kind == "diagonal" else np.eye(m) if kind == "identity" else (q * values) @ q.T
    a = (a + a.T) / 2
    e, v = wh.eigen(a)
    scale = np.linalg.norm(a)
    assert np.abs(v.T @ v - np.eye(m)).max() < 1e-13
    assert np.abs(v.T @ a @ v - np.diag(e)).max() < 2e-14 * scale * m
    assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() < 1e-14 * scale * m and list(e) == sorted(e, reverse=True)


def test_polar_factor_is_the_matrix_sign():
    r = np.random.default_rng(1)
    a = r.standard_normal((25, 25))
    a = a + a.T
    u = wh.polar(a)
    e, v = np.linalg.eigh(a)
    assert np.abs(u - (v * np.sign(e)) @ v.T).max() < 1e-11


def check(rows, got, components=32):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    s = [sum(v[j] for v in x) for j in range(d)]
    dev = [sum((n * v[j] - s[j]) ** 2 for j in range(d)) for v in x]
    y = np.array([[float(Fraction(n * v[j] - s[j], n)) for j in range(d)] for v in x])
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, d)
    assert len(got) == n * k and {g.n for g in got} == {n}
    assert sorted((g.vec_id, g.deviation) for g in got if g.component == 1) == sorted((i, v) for (i, _), v in zip(good, dev, strict=True))
    by = {c: sorted([(g.vec_id, g.whitened) for g in got if g.component == c]) for c in range(1, k + 1)}
    for g in got:
        assert abs(g.explained / (e[g.component - 1] / e.sum()) - 1) < 1e-9
    order = sorted(range(n), key=lambda i: good[i][0])
    for c in range(1, k + 1):
        w = np.array([v for _, v in by[c]])
        want = (y @ q[:, c - 1] / np.sqrt(e[c - 1]))[order]
        assert min(np.abs(w - want).max(), np.abs(w + want).max()) < 1e-6
    w = np.array([[v for _, v in by[c]] for c in range(1, k + 1)])
    error = np.abs((w - w.mean(axis=1, keepdims=True)) @ (w - w.mean(axis=1, keepdims=True)).T / n - np.eye(k)).max()
    assert {g.identity_error for g in got} == {got[0].identity_error} and got[0].identity_error < 1e-9 and error < 1e-9


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    check(rows, wh.whiten(df.repartition(5)).collect())


def test_bad_vectors_extra_columns_and_repeated_rows(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(c) for c in r.standard_normal(6) * [9, 5, 3, 2, 1, 0.5]]) for i in range(200)]
    rows += [(500, None), (501, []), *((502 + k, [c, *[0.0] * 4, 1.0]) for k, c in enumerate((None, math.nan, math.inf, -math.inf)))]
    odd = [(506, [1.0, 2.0]), (507, [1e300, 0.0, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, 2, 0.5) for i, v in rows + odd], "vec_id long, embedding array<double>, n int, component int, vector double")
    check(rows, wh.whiten(df.repartition(3)).collect())
    check(rows, wh.whiten(df, components=2).collect(), 2)
    twice = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (1, [0.0, 2.0]), (1, [5.0, 1.0])], "vec_id long, embedding array<float>")
    got = wh.whiten(twice).collect()
    assert sorted((g.vec_id is None, g.component) for g in got) == [(False, 1)] * 2 + [(False, 2)] * 2 + [(True, 1)] * 2 + [(True, 2)] * 2


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(3**i), float(i)]) for i in range(25)]
    got = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()
    n = len(rows)
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in rows]
    s = [sum(v[j] for v in x) for j in range(2)]
    want = {i: sum((n * v[j] - s[j]) ** 2 for j in range(2)) for (i, _), v in zip(rows, x, strict=True)}
    assert {g.vec_id: g.deviation for g in got} == {i: v if v < 2**63 else None for i, v in want.items()}
    assert any(v is None for v in [g.deviation for g in got]) and got[0].identity_error < 1e-9


def test_empty_table_and_no_spread(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = wh.whiten(spark.createDataFrame(rows, schema))
        assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
