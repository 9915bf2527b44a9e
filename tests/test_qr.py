"""Least squares by QR on data where raw moments fail."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import gram as G
from keelson.operators import qr as Q


def exact(x, y):
    """Slope and intercept in rational arithmetic."""
    x, y = [Fraction(v) for v in x], [Fraction(v) for v in y]
    mx, my = sum(x) / len(x), sum(y) / len(y)
    slope = sum((a - mx) * (b - my) for a, b in zip(x, y)) / sum((a - mx) ** 2 for a in x)
    return float(my - slope * mx), float(slope)


def test_a_feature_far_off_its_centre(spark):
    rng = np.random.default_rng(1)
    x = [float(1e8 + v) for v in rng.standard_normal(400)]
    y = [float(3 * (a - 1e8) + 2 + 0.01 * rng.standard_normal()) for a in x]
    df = spark.createDataFrame(list(zip(x, y)), "x double, y double").repartition(5)
    theta = Q.factor(df, ["x"], "y").coefficients()
    assert theta == pytest.approx(exact(x, y), rel=1e-8)
    raw = G.solve(G.gram(df, ["x"], "y"))
    assert abs(raw[1] - theta[1]) > 1e-4      # what raw moments give
    f = Q.factor(df, ["x"], "y")
    res = np.array(y) - theta[0] - theta[1] * np.array(x)
    assert f.cost(theta) == pytest.approx((res ** 2).sum() / 800, rel=1e-6)


def test_nearly_collinear_features_and_arrays(spark):
    rng = np.random.default_rng(2)
    a = rng.standard_normal(300)
    X = np.stack([a, a + 1e-7 * rng.standard_normal(300), rng.standard_normal(300)], axis=1)
    y = X @ [1.0, 2.0, -1.0] + 0.5
    df = spark.createDataFrame([([float(v) for v in r], float(t)) for r, t in zip(X, y)], "v array<double>, y double").repartition(3)
    assert Q.factor(df, "v", "y").coefficients() == pytest.approx([0.5, 1.0, 2.0, -1.0], rel=1e-6)
    want = np.linalg.lstsq(np.vstack([np.hstack([np.ones((300, 1)), X]), np.sqrt(3.0) * np.eye(4)[1:]]),
                           np.concatenate([y, np.zeros(3)]), rcond=None)[0]
    assert Q.factor(df, "v", "y").coefficients(3.0) == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_the_tree_of_factors_equals_one_factor(spark, monkeypatch):
    rng = np.random.default_rng(3)
    X = rng.standard_normal((500, 3))
    y = X @ [1.0, -2.0, 0.5] + rng.standard_normal(500)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(X, y))]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double, y double").repartition(30)
    monkeypatch.setattr(Q, "FAN", 3)
    monkeypatch.setattr(Q, "ROWS", 7)
    f = Q.factor(df, ["a", "b", "c"], "y")
    assert f.n == 500
    want = np.linalg.lstsq(np.hstack([np.ones((500, 1)), X]), y, rcond=None)[0]
    assert f.coefficients() == pytest.approx(want, rel=1e-10)
    fold = np.arange(500) % 4
    groups = Q.factors(df, ["a", "b", "c"], "y", F.col("i") % 4)
    for g, rest in Q.without_each(groups).items():
        on = fold != g
        want = np.linalg.lstsq(np.hstack([np.ones((on.sum(), 1)), X[on]]), y[on], rcond=None)[0]
        assert rest.n == on.sum() and rest.coefficients() == pytest.approx(want, rel=1e-10)
        err = y[~on] - np.hstack([np.ones(((~on).sum(), 1)), X[~on]]) @ want
        assert groups[g].cost(want) == pytest.approx((err ** 2).mean() / 2, rel=1e-10)


def test_bad_rows_and_no_rows(spark):
    rows = [(1.0, 2.0), (2.0, 4.5), (3.0, 5.5), (None, 1.0), (float("nan"), 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    good = [r for r in rows[:3]]
    assert Q.factor(df, ["x"], "y").coefficients() == pytest.approx(exact(*zip(*good)))
    assert Q.factors(df.limit(0), ["x"], "y") == {}
    with pytest.raises(ValueError):
        Q.factor(df.limit(0), ["x"], "y")
