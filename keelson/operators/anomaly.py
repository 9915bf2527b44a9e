"""Gaussian anomaly detection (A1-A5).

The best-threshold search evaluates a 1000-point epsilon grid in ONE pass:
each row is mapped to the first grid slot whose epsilon exceeds its density
(computed with the very same epsilon expression, so p < eps is honoured at
slot edges), slots are counted with partial aggregation (<= 1001 groups)
and the confusion counts of every grid point are running sums over slots."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete, normal_log_pdf


def estimate_params(df: DataFrame, cols: Sequence[str]) -> tuple[list[float], list[float]]:
    """A1: per-feature mean and population variance of the complete rows (one
    aggregate)."""
    df, aggs = complete(df, cols), []
    for i, c in enumerate(cols):
        aggs += [F.avg(col(c)).alias(f"mu{i}"), F.var_pop(col(c)).alias(f"var{i}")]
    r = df.agg(*aggs).first()
    return ([float(r[f"mu{i}"]) for i in range(len(cols))],
            [float(r[f"var{i}"]) for i in range(len(cols))])


def estimate_covariance(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Mean vector and population covariance matrix of the complete rows (one
    aggregate)."""
    df, n = complete(df, cols), len(cols)
    aggs = [F.avg(col(c)).alias(f"mu{i}") for i, c in enumerate(cols)]
    for i in range(n):
        for j in range(i, n):
            aggs.append(F.covar_pop(col(cols[i]), col(cols[j])).alias(f"c{i}_{j}"))
    r = df.agg(*aggs).first()
    mu = np.array([r[f"mu{i}"] for i in range(n)], dtype=float)
    S = np.zeros((n, n))
    for i in range(n):
        for j in range(i, n):
            S[i, j] = S[j, i] = r[f"c{i}_{j}"]
    return mu, S


def log_density(cols: Sequence[str], mu: Sequence[float], var: Sequence[float]) -> Column:
    """A2 on the log scale: sum of univariate normal log densities
    (diagonal covariance)."""
    out = None
    for c, m, v in zip(cols, mu, var):
        t = normal_log_pdf(c, m, v)
        out = t if out is None else out + t
    return out


def mv_log_density(cols: Sequence[str], mu: np.ndarray, S: np.ndarray) -> Column:
    """A3: multivariate normal log density with full covariance; the
    inverse and determinant are computed once on the driver."""
    n = len(cols)
    P = np.linalg.inv(S)
    _, logdet = np.linalg.slogdet(S)
    d = [col(c) - F.lit(float(m)) for c, m in zip(cols, mu)]
    q = None
    for i in range(n):
        for j in range(n):
            t = d[i] * d[j] * F.lit(float(P[i, j]))
            q = t if q is None else q + t
    const = -0.5 * (n * math.log(2 * math.pi) + logdet)
    return F.lit(const) - F.lit(0.5) * q


def f1_at(df: DataFrame, p: str, truth: str, eps: float) -> DataFrame:
    """A4: tp, fp, fn, precision, recall, F1 for predicted = p < eps
    (undefined ratios are 0) over the rows with a density and a truth."""
    df = complete(df, [p, truth])
    pred = col(p) < F.lit(eps)
    pos = col(truth) == 1
    c = df.agg(F.sum((pred & pos).cast("long")).alias("tp"),
               F.sum((pred & ~pos).cast("long")).alias("fp"),
               F.sum((~pred & pos).cast("long")).alias("fn"))
    return _with_f1(c).select(F.lit(eps).alias("epsilon"), "tp", "fp", "fn",
                              "precision", "recall", "f1")


def _with_f1(c: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    c = c.withColumn("precision", prec).withColumn("recall", rec)
    return c.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall")
                                     / (F.col("precision") + F.col("recall"))).otherwise(0.0))


def best_threshold(df: DataFrame, p: str, truth: str, steps: int = 1000) -> tuple[float, float]:
    """A5: epsilon_i = min + i * (max - min) / steps, i = 0..steps-1; the
    first epsilon with the highest F1 wins.  One min/max aggregate and one
    grouped count over at most steps + 1 slots.  Rows with a null or NaN density
    or truth take no part; without rows the result is (nan, 0)."""
    df = complete(df, [p, truth])
    r = df.agg(F.min(col(p)).alias("lo"), F.max(col(p)).alias("hi")).first()
    if r["lo"] is None:
        return float("nan"), 0.0
    lo, hi = float(r["lo"]), float(r["hi"])
    step = (hi - lo) / steps
    if step == 0.0:
        return lo, 0.0

    def eps_at(i: Column) -> Column:
        return F.lit(lo) + i.cast("double") * F.lit(step)

    pc = col(p)
    c = F.floor((pc - F.lit(lo)) / F.lit(step)).cast("long")
    slot = F.lit(steps)
    for cand in (c + 2, c + 1, c, c - 1):
        ok = (cand >= 0) & (cand < steps) & (eps_at(cand) > pc)
        slot = F.when(ok, cand).otherwise(slot)
    counts = (df.groupBy(slot.alias("slot"))
              .agg(F.sum((col(truth) == 1).cast("long")).alias("pos"),
                   F.sum((col(truth) != 1).cast("long")).alias("neg")))
    rows = sorted((int(x["slot"]), int(x["pos"]), int(x["neg"])) for x in counts.collect())
    total_pos = sum(x[1] for x in rows)
    best_i, best_f1, tp, fp = 0, 0.0, 0, 0
    for s, pos, neg in rows:
        if s >= steps:
            break
        tp, fp = tp + pos, fp + neg
        fn = total_pos - tp
        prec = tp / (tp + fp) if tp + fp else 0.0
        rec = tp / (tp + fn) if tp + fn else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        if f1 > best_f1:
            best_i, best_f1 = s, f1
    return lo + best_i * step, best_f1


def outliers(df: DataFrame, p: str, eps: float) -> DataFrame:
    """Rows whose density is below epsilon."""
    return df.filter(col(p) < F.lit(eps))

