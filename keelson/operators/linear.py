"""Linear regression: hypothesis, cost, gradient, normal equation, ridge,
batch gradient descent, accuracy, cost surface, fitted curve.

Every fit needs one scan: the augmented Gram matrix (``gram``).  Gradient
descent then iterates on the driver over (n+2)^2 numbers, so any number of
iterations or learning rates costs no further Spark job."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete, linear
from keelson.operators import gram as G


def hypothesis(cols: Sequence[Column | str], theta: Sequence[float]) -> Column:
    """L1: theta_0 + sum theta_j x_j."""
    return linear(cols, theta[1:], intercept=theta[0])


def cost_frame(df: DataFrame, cols: Sequence[str], y: str, theta: Sequence[float],
               lam: float = 0.0, name: str = "J") -> DataFrame:
    """L2: sum (h - y)^2 / 2m + lam/2m sum_{j>=1} theta_j^2, one aggregate."""
    h = hypothesis(cols, theta)
    d = h - col(y)
    reg = float(sum(t * t for t in theta[1:]))
    m = F.count(F.lit(1))
    return complete(df, [*cols, y]).agg(((F.sum(d * d) + F.lit(lam * reg)) / (F.lit(2.0) * m)).alias(name))


def gradient_frame(df: DataFrame, cols: Sequence[str], y: str, theta: Sequence[float],
                   lam: float = 0.0) -> DataFrame:
    """L3: X'(h - y)/m + lam/m [0; theta_1..], all n+1 sums in one aggregate;
    long output (idx, grad)."""
    h = hypothesis(cols, theta)
    d = h - col(y)
    xs = [F.lit(1.0)] + [col(c) for c in cols]
    m = F.count(F.lit(1))
    aggs = []
    for j, x in enumerate(xs):
        reg = 0.0 if j == 0 else lam * theta[j]
        aggs.append(((F.sum(d * x) + F.lit(reg)) / m).alias(f"g{j}"))
    wide = complete(df, [*cols, y]).agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(j).alias("idx"), F.col(f"g{j}").alias("grad")) for j in range(len(xs))])))


def fit_normal(df: DataFrame, cols: Sequence[str], y: str, lam: float = 0.0) -> np.ndarray:
    """theta = pinv(X'X + lam D) X'y from one Gram scan."""
    return G.solve(G.gram(df, cols, y), lam)


def theta_frame(spark: SparkSession, theta: Sequence[float], name: str = "theta") -> DataFrame:
    return spark.createDataFrame([(j, float(t)) for j, t in enumerate(theta)],
                                 f"idx int, {name} double")


def gradient_descent(Gm: np.ndarray, alpha: float, iters: int, lam: float = 0.0,
                     theta0: Sequence[float] | None = None, l2_in_step: bool = False,
                     tol: float | None = None) -> list[tuple[int, float, np.ndarray]]:
    """Theta <- theta - alpha/m X'(X theta - y) on the Gram matrix.

    Returns [(iteration, J, theta)], iteration 0 = start.  The step ignores
    lam unless ``l2_in_step``; J always includes it.  With ``tol`` the loop
    stops when |J_new - J_old| <= tol.  A rising J is a divergence warning
    (returned path shows it)."""
    k = Gm.shape[0] - 1
    theta = np.zeros(k) if theta0 is None else np.asarray(theta0, dtype=float)
    path = [(0, G.cost(Gm, theta, lam), theta.copy())]
    for it in range(1, iters + 1):
        grad = G.gradient(Gm, theta, lam if l2_in_step else 0.0)
        theta = theta - alpha * grad
        J = G.cost(Gm, theta, lam)
        path.append((it, J, theta.copy()))
        if tol is not None and abs(path[-1][1] - path[-2][1]) <= tol:
            break
    return path


def accuracy_frame(df: DataFrame, cols: Sequence[str], y: str, theta: Sequence[float]) -> DataFrame:
    """Mean squared error and mean(1 - |h - y| / y) * 100 over the complete
    rows; a row with y = 0 has no relative error and counts in the first only."""
    h = hypothesis(cols, theta)
    share = F.lit(1.0) - F.try_divide(F.abs(h - col(y)), col(y))
    return complete(df, [*cols, y]).agg(F.avg((h - col(y)) * (h - col(y))).alias("mse"),
                                        (F.avg(share) * F.lit(100.0)).alias("accuracy_pct"))


def cost_surface(spark: SparkSession, Gm: np.ndarray, t0_range, t1_range, n: int) -> DataFrame:
    """J over an n x n (theta0, theta1) grid for a one-feature model.
    J is quadratic in theta, so each grid point is an expression over five
    Gram entries (inlined): no scan of the data per point."""
    from keelson.operators.features import grid_2d
    m, sx, sy = Gm[0, 0], Gm[0, 1], Gm[0, 2]
    sxx, sxy, syy = Gm[1, 1], Gm[1, 2], Gm[2, 2]
    g = grid_2d(spark, t0_range, t1_range, n, names=("theta0", "theta1"))
    a, b = F.col("theta0"), F.col("theta1")
    L = F.lit
    sse = (L(syy) - L(2.0) * a * L(sy) - L(2.0) * b * L(sxy) + L(m) * a * a
           + L(2.0) * a * b * L(sx) + b * b * L(sxx))
    return g.withColumn("cost", sse / L(2.0 * m))


def r2_frame(df: DataFrame, pred: Column, y: str) -> DataFrame:
    """1 - SSE/SST in one pass (SST from sums)."""
    yy = col(y)
    sse = F.sum((yy - pred) * (yy - pred))
    sst = F.var_pop(yy) * F.count(F.lit(1))
    return df.filter(pred.isNotNull() & yy.isNotNull()).agg((F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"))
