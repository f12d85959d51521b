"""Whitening against a covariance in whole numbers and numpy's own."""

from fractions import Fraction

import numpy as np
import pytest

from starloom.llm import whitening
from starloom.llm.whitening import squares, totals, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, deviation string, component int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "a", "b", "c", 0) for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def cloud(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 3).astype(np.float32)


def fit_of(vectors):
    return sorted({tuple(int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v) for v in vectors})


def test_covariance_is_the_exact_one(spark):
    vectors = [*cloud(300, 7), *cloud(300, 7)[:50]]
    fit = whitening.fit_list(whitening.whole_numbers(table(spark, vectors)))
    rows, d = fit_of(vectors), 7
    n = len(rows)
    assert fit.count() == n
    sums = totals(fit, d)
    assert sums == [sum(r[i] for r in rows) for i in range(d)]
    of = squares(fit, n, sums)
    assert of == {(i, j): sum(((n * r[i] - sums[i]) + (n * r[j] - sums[j]) * (i != j)) ** 2 for r in rows) for i in range(d) for j in range(i, d)}
    v = whitening.covariance(of, n, d)
    exact = [[Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in rows), n**3) for j in range(d)] for i in range(d)]
    assert all(v[i, j] == float(exact[i][j]) for i in range(d) for j in range(d))


def test_whitened_rows_against_numpy(spark):
    vectors = [*cloud(400, 20), *cloud(400, 20)[:30], None, [None] + [0] * 19, [float("nan")] + [0] * 19, [float("inf")] + [0] * 19]
    ids = [None, 7, 7, *range(len(vectors) - 3)]
    white, model, error = whiten(table(spark, vectors, ids))
    fit = np.array(fit_of(vectors[:430]), float)
    n, mean = len(fit), fit.mean(axis=0)
    v = (fit - mean).T @ (fit - mean) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    got = white.collect()
    assert model.n == n and len(got) == 430 and error < 1e-9
    assert np.allclose(model.explained, e / np.trace(v), rtol=1e-9)
    own = sorted((r.vec_id is not None, r.vec_id or 0, r.deviation, *np.abs(r.whitened).round(6)) for r in got)
    brute = []
    for i, vector in zip(ids[:430], vectors[:430], strict=True):
        x = np.floor(np.float64(vector) * 64) + 1_000_000
        w = (x - mean) @ u / np.sqrt(e)
        brute.append((i is not None, i or 0, sum((n * int(c) - int(s)) ** 2 for c, s in zip(x, fit.sum(axis=0), strict=True)), *np.abs(w).round(6)))
    brute.sort()
    assert [r[:3] for r in own] == [r[:3] for r in brute]
    assert np.allclose([r[3:] for r in own], [r[3:] for r in brute], atol=1e-5)


def test_query_result_in_long_form(spark, tmp_path):
    table(spark, cloud(50, 18)).select("vec_id", "embedding", "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    df = whitening.op12_whitening(spark, str(tmp_path))
    assert dict(df.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    rows = df.collect()
    assert sorted((r.vec_id, r.component) for r in rows) == [(i, c) for i in range(50) for c in range(1, 17)]
    assert {r.n for r in rows} == {50} and all(r.identity_error < 1e-6 for r in rows)
    explained = [next(r.explained for r in rows if r.component == c) for c in range(1, 17)]
    assert explained == sorted(explained, reverse=True)


def test_directions_without_variance(spark):
    flat = [[float(i), 2.0 * i, 5.0] for i in range(6)]
    white, model, error = whiten(table(spark, flat))
    assert model.alive == 1 and error < 1e-9 and model.explained[1:].tolist() == [0, 0]
    assert all(r.whitened[1:] == [0, 0] for r in white.collect())
    white, model, error = whiten(table(spark, [[1.0, 2.0]] * 3))
    assert model.n == 1 and error == 0 and [r.whitened for r in white.collect()] == [[0.0, 0.0]] * 3


def test_empty_tables_and_unequal_lengths(spark):
    assert whiten(table(spark, []))[0].count() == 0
    assert whiten(table(spark, [None, [float("nan")]]))[0].count() == 0
    assert whiten(table(spark, [[], []]))[0].count() == 0
    with pytest.raises(ValueError):
        whiten(table(spark, [[1.0], [1.0, 2.0]]))


def test_sums_of_squares_beyond_a_long():
    t = np.array([[(1 << 50) - 3, -(1 << 49) + 5, 7], [-(1 << 50) + 1, (1 << 48) + 1, -9]] * 2000, np.int64)
    assert whitening._sum_of_squares(t) == [sum(int(x) ** 2 for x in column) for column in t.T]
    assert whitening.centred(np.array([[5, -7]]), 3, [10, -20]).tolist() == [[5, -1]]
    with pytest.raises(OverflowError):
        whitening.centred(np.array([[1 << 40, 0]]), 1 << 10, [0, 0])
