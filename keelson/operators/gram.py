"""Sufficient statistics: the augmented Gram matrix.

For z = [1, x_1 .. x_n, y] the matrix G = sum z z' (one scan) determines
least squares, ridge, gradient descent paths, cost surfaces, learning and
validation curves and k-fold refits.  Narrow designs use one aggregate with
n(n+1)/2 products (map-side partial aggregation, a single tiny shuffle);
wide array features use per-partition partial products in Arrow batches,
emitted as long (i, j, value) rows and summed by key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete, complete_vector


def _pairs(k: int):
    for i in range(k):
        for j in range(i, k):
            yield i, j


def gram_aggs(terms: Sequence[Column]) -> list[Column]:
    """Aggregate columns g_i_j = sum(t_i * t_j), i <= j, plus the count."""
    out = [F.count(F.lit(1)).alias("g_n")]
    for i, j in _pairs(len(terms)):
        out.append(F.sum(terms[i] * terms[j]).alias(f"g_{i}_{j}"))
    return out


def gram_frame(df: DataFrame, cols: Sequence[Column | str], y: Column | str | None = None,
               group_cols: Sequence[str] = (), intercept: bool = True) -> DataFrame:
    """One row per group with the upper triangle of G = sum z z' over the rows
    in which all of ``cols`` and ``y`` are present."""
    df = complete(df, [*cols, *([y] if y is not None else [])])
    terms = ([F.lit(1.0)] if intercept else []) + [col(c).cast("double") for c in cols]
    if y is not None:
        terms.append(col(y).cast("double"))
    aggs = gram_aggs(terms)
    if group_cols:
        return df.groupBy(*group_cols).agg(*aggs)
    return df.agg(*aggs)


def gram_from_row(row, k: int) -> np.ndarray:
    g = np.zeros((k, k))
    for i, j in _pairs(k):
        v = row[f"g_{i}_{j}"]
        g[i, j] = g[j, i] = 0.0 if v is None else float(v)
    return g


def gram(df: DataFrame, cols: Sequence[Column | str], y: Column | str | None = None,
         intercept: bool = True) -> np.ndarray:
    """G for the augmented design as a small numpy matrix (one job)."""
    k = len(cols) + (1 if intercept else 0) + (1 if y is not None else 0)
    row = gram_frame(df, cols, y, intercept=intercept).first()
    return gram_from_row(row, k)


def grouped_grams(df: DataFrame, cols: Sequence[Column | str], y: Column | str | None,
                  group_col: str, intercept: bool = True) -> dict:
    """G per group value (groups must be few: folds, splits, size buckets)."""
    k = len(cols) + (1 if intercept else 0) + (1 if y is not None else 0)
    rows = gram_frame(df, cols, y, group_cols=[group_col], intercept=intercept).collect()
    return {r[group_col]: gram_from_row(r, k) for r in rows}


def gram_long(df: DataFrame, array_col: str, dims: int, centre: Sequence[float] | None = None,
              scale: Sequence[float] | None = None, with_count: bool = False) -> DataFrame:
    """Wide Gram sum x x' for an array<double|float> column as long rows
    (i, j, value), i <= j, over the complete vectors; ``with_count`` adds their
    number n to each row.  Each Arrow batch contributes X'X computed by numpy
    from its flat buffer; partial rows are summed by (i, j), spread over dims^2
    keys."""
    mu = np.zeros(dims) if centre is None else np.asarray(centre, dtype=float)
    sd = np.ones(dims) if scale is None else np.asarray(scale, dtype=float)
    sd = np.where(sd == 0, 1.0, sd)
    iu = np.triu_indices(dims)

    def partials(batches):
        import pyarrow as pa
        acc, n = np.zeros((dims, dims)), 0
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            x = (x - mu) / sd
            acc += x.T @ x
            n += len(x)
        if n:
            yield pa.record_batch([pa.array(iu[0].astype("int32")), pa.array(iu[1].astype("int32")), pa.array(acc[iu]),
                                   pa.array(np.full(len(iu[0]), n))], names=["i", "j", "value", "n"])

    part = (df.filter(complete_vector(array_col)).select(col(array_col).cast("array<double>").alias("x"))
            .mapInArrow(partials, "i int, j int, value double, n long"))
    return part.groupBy("i", "j").agg(F.sum("value").alias("value"), *([F.sum("n").alias("n")] if with_count else []))


def long_to_matrix(rows, dims: int, i="i", j="j", v="value") -> np.ndarray:
    g = np.zeros((dims, dims))
    for r in rows:
        g[r[i], r[j]] = g[r[j], r[i]] = r[v]
    return g


# ---------- closed forms on G (driver side, (n+2)^2 numbers) ----------

def split_gram(G: np.ndarray):
    """A = X'X, b = X'y, yy = y'y, m = row count (intercept in column 0)."""
    return G[:-1, :-1], G[:-1, -1], G[-1, -1], G[0, 0]


def penalty(k: int, lam: float, intercept: bool = True) -> np.ndarray:
    d = np.full(k, float(lam))
    if intercept:
        d[0] = 0.0
    return np.diag(d)


def solve(G: np.ndarray, lam: float = 0.0, intercept: bool = True) -> np.ndarray:
    """theta = pinv(X'X + lam * diag(0, 1, .., 1)) X'y."""
    A, b, _, _ = split_gram(G)
    return np.linalg.pinv(A + penalty(A.shape[0], lam, intercept)) @ b


def cost(G: np.ndarray, theta: np.ndarray, lam: float = 0.0, intercept: bool = True) -> float:
    """J = (theta'A theta - 2 theta'b + y'y) / 2m + lam/2m * sum theta_j^2 (j >= 1)."""
    A, b, yy, m = split_gram(G)
    sse = float(theta @ A @ theta - 2.0 * theta @ b + yy)
    reg = float(np.sum(theta[1:] ** 2) if intercept else np.sum(theta ** 2))
    return float(sse / (2.0 * m) + lam * reg / (2.0 * m))


def gradient(G: np.ndarray, theta: np.ndarray, lam: float = 0.0, intercept: bool = True) -> np.ndarray:
    A, b, _, m = split_gram(G)
    g = (A @ theta - b) / m
    reg = theta.copy()
    if intercept:
        reg[0] = 0.0
    return g + lam / m * reg
