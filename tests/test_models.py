"""Linear fits and k-means against plain numpy on small tables."""

from __future__ import annotations

import numpy as np
import pytest

from logsonde.functions.linear_models import Encoding, encode, fit_logistic, fit_ridge, predict_test
from logsonde.operators import segments


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(600):
        x, c = float(rng.normal(50, 9)), str(rng.choice(["a", "b", "c"]))
        y = int(rng.random() < 1 / (1 + np.exp(-(x - 55) / 6 - (c == "a"))))
        rows.append((None if i % 37 == 0 else x, None if i % 41 == 0 else c if i % 53 else "new", y, 3 * x + rng.normal() if i % 29 else None, i % 5 == 0))
    return rows, spark.createDataFrame(rows, "x double, c string, y int, v double, is_test boolean")


ENCODING = Encoding({"x": 50.0}, {"c": ["a", "b", "c"]}, {"c": "b"})


def dense(rows, side):
    own = [r for r in rows if r[4] == side]
    x = np.zeros((len(own), 5))
    for i, (number, c, *_) in enumerate(own):
        x[i, 0] = (50.0 if number is None else number) - 50.0
        x[i, 4] = 1
        if (c or "b") in "abc":
            x[i, 1 + "abc".index(c or "b")] = 1
    return x, np.array([r[2] for r in own], float), np.array([np.nan if r[3] is None else r[3] for r in own])


def test_fits_equal_dense_solutions(table):
    rows, df = table
    blocks = encode(df, ENCODING, ["y", "v"])
    x, y, v = dense(rows, False)
    ridge = np.diag([1.0, 1, 1, 1, 0])
    weight = np.where(y == 1, len(y) / 2 / y.sum(), len(y) / 2 / (len(y) - y.sum()))
    beta = np.zeros(5)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        beta = beta - np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge, x.T @ (weight * (p - y)) + ridge @ beta)
    fits = fit_logistic(blocks, ENCODING, {"y": (0, weight[y == 1][0], weight[y == 0][0])})
    np.testing.assert_allclose(fits["y"].coefficients, beta, atol=1e-7)
    assert fits["y"].gradient < 1e-8
    known = ~np.isnan(v)
    line = np.linalg.solve(x[known].T @ x[known] + ridge, x[known].T @ v[known])
    fit = fit_ridge(blocks, ENCODING, 1)
    np.testing.assert_allclose(fit.coefficients, line, rtol=1e-8)
    tx, ty, tv = dense(rows, True)
    got = predict_test(blocks, ENCODING, ["y", "v"], fits, {"v": fit}).toPandas()
    assert sorted(zip(got["y"], got["pred_y"])) == sorted(zip(ty, (tx @ beta > 0).astype(float)))
    np.testing.assert_allclose(np.sort(got["pred_v"]), np.sort(tx @ line), rtol=1e-8)
    assert got["v"].isna().sum() == np.isnan(tv).sum()


def test_kmeans_passes_equal_plain_ones(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(m, 0.6, (60, 3)) for m in (-2, 0, 3)])
    df = spark.createDataFrame([(r.tolist(),) for r in x], "features array<double>")
    centres = x[[0, 70, 130]]
    got = segments.fit_kmeans(df, [3], initial={3: centres}, max_iterations=4)[3]
    for _ in range(got.passes):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.stack([x[near == i].mean(0) for i in range(3)])
    np.testing.assert_allclose(got.at, centres, rtol=1e-9)
    assert got.cost == pytest.approx(((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum(), rel=1e-9)
    fits = segments.fit_kmeans(df, [2, 3], starts=3)
    assert fits[3].cost < fits[2].cost
    same = segments.fit_kmeans(spark.createDataFrame([([1.0, 2.0],)] * 5, "features array<double>"), [3], starts=2)
    assert same[3].cost == pytest.approx(0, abs=1e-9)
    with pytest.raises(ValueError):
        segments.fit_kmeans(df.limit(0), [2])
