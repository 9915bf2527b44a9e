"""Wide and sparse components, array projections, the kernel machine."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import pca as PC
from keelson.operators import svm as SV


def low_rank(n=300, d=64, seed=1):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, d)) @ np.diag(0.6 ** np.arange(d)) @ np.linalg.qr(rng.standard_normal((d, d)))[0]


def angle(A, B):
    """Sine of the largest angle between the spans."""
    A, B = np.linalg.qr(A)[0], np.linalg.qr(B)[0]
    return np.linalg.norm(A - B @ (B.T @ A), 2)


def array_frame(spark, X):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(X)], "id long, v array<double>").repartition(3)


def test_subspace_of_arrays_equals_the_eigenvectors(spark):
    X = low_rank()
    df = array_frame(spark, X).unionByName(spark.createDataFrame([(900, None), (901, [None] * 64), (902, [float("nan")] * 64)], "id long, v array<double>"))
    want = PC.directions(X.T @ X / len(X))
    got = PC.subspace(df, "v", 5, iters=25)
    assert got.S == pytest.approx(want.S[:5], rel=1e-9)
    assert angle(got.U, want.U[:, :5]) < 1e-6
    z = {r["id"]: r["z"] for r in PC.project_array(df, "v", got, 3).collect()}
    assert z[900] is z[901] is z[902] is None and len(z) == 303
    assert z[7] == pytest.approx(X[7] @ got.U[:, :3])
    back = PC.reconstruct_array(PC.project_array(df, "v", got, 5), "z", got, 5)
    x = {r["id"]: r["x_rec"] for r in back.collect()}
    assert x[11] == pytest.approx(X[11] @ got.U @ got.U.T) and x[900] is None
    assert set(back.columns) == {"id", "v", "z", "x_rec"}
    few = PC.subspace(array_frame(spark, X[:, :3]), "v", 5)
    assert few.S == pytest.approx(PC.directions(X[:, :3].T @ X[:, :3] / len(X)).S, rel=1e-9)


def test_subspace_of_sparse_rows_equals_the_eigenvectors(spark):
    rng = np.random.default_rng(3)
    X = np.where(rng.random((120, 40)) < 0.3, rng.random((120, 40)), 0.0)
    X[:, :8] += rng.random((120, 1)) * np.arange(8)
    X[:, 8:12] += rng.random((120, 1)) * 9
    X[:, 20:23] += rng.random((120, 1)) * 30
    rows = [(i, f"t{j}", float(X[i, j])) for i in range(120) for j in range(40) if X[i, j]]
    df = spark.createDataFrame(rows, "doc_id long, term string, w double").repartition(4)
    want = PC.directions(X.T @ X / 120)
    got = PC.sparse_subspace(df, 3, iters=12)
    assert got.S == pytest.approx(want.S[:3], rel=1e-8)
    U = np.zeros((40, 3))
    for r in got.table().collect():
        U[int(r["term"][1:]), r["component"]] = r["weight"]
    assert angle(U, want.U[:, :3]) < 1e-6 and U.T @ U == pytest.approx(np.eye(3), abs=1e-9)
    z = {(r["doc_id"], r["component"]): r["z"] for r in got.project(df).collect()}
    assert all(z[i, c] == pytest.approx(X[i] @ U[:, c], abs=1e-9) for i in range(0, 120, 17) for c in range(3))


def ring(n=60, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1.2, 1.2, (n, 2))
    r = (x ** 2).sum(axis=1)
    y = ((r > 0.25) & (r < 1.1)).astype(int)
    y[rng.random(n) < 0.05] ^= 1
    return x, y


def exact_machine(x, y, sigma, C):
    """The kernel machine's objective by coordinate pairs on its dual."""
    s = np.where(y == 1, 1.0, -1.0)
    K = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * sigma ** 2))
    a, f = np.zeros(len(x)), np.zeros(len(x))      # f = K (a s)
    for _ in range(20_000):
        up = ((s > 0) & (a < C)) | ((s < 0) & (a > 0))
        low = ((s > 0) & (a > 0)) | ((s < 0) & (a < C))
        g = s - f
        i, j = np.where(up, g, -np.inf).argmax(), np.where(low, g, np.inf).argmin()
        if g[i] - g[j] < 1e-8:
            break
        t = (g[i] - g[j]) / max(K[i, i] + K[j, j] - 2 * K[i, j], 1e-12)
        t = min(t, C - a[i] if s[i] > 0 else a[i], a[j] if s[j] > 0 else C - a[j])
        a[i] += s[i] * t
        a[j] -= s[j] * t
        f += t * (K[:, i] - K[:, j])
    b = (g[i] + g[j]) / 2
    w = a * s
    return 0.5 * w @ K @ w + C * np.maximum(0, 1 - s * (f + b)).sum(), w, b


def test_the_kernel_machine_reaches_the_exact_objective(spark):
    x, y = ring()
    df = spark.createDataFrame([([float(v) for v in r], int(t)) for r, t in zip(x, y)], "v array<double>, y int").repartition(2)
    sigma, C = 0.4, 2.0
    want, w, b = exact_machine(x, y, sigma, C)
    coef, intercept = SV.fit_rbf(df, "v", "y", x, sigma, C)
    got = SV.kernel_objective(df, "v", "y", x, coef, intercept, sigma, C)
    assert want <= got * (1 + 1e-9) and got <= 1.01 * want
    assert SV.kernel_objective(df, "v", "y", x, w, b, sigma, C) == pytest.approx(want, rel=1e-9)
    pred = df.withColumn("p", SV.classify(SV.rbf_score("v", x, coef, intercept, sigma))).filter("p = y").count()
    assert pred >= 0.9 * len(y)


def test_repeated_landmarks_and_the_map(spark):
    x, _ = ring(20)
    L = np.vstack([x, x[:5]])
    M = SV.nystrom_map(L, 0.5)
    K = np.exp(-((L[:, None] - L[None]) ** 2).sum(axis=2) / 0.5)
    assert (K @ M) @ (K @ M).T == pytest.approx(K, abs=1e-6) and M.shape[1] <= 20
    df = spark.createDataFrame([(1, [float(v) for v in x[0]]), (2, None)], "id long, v array<double>")
    got = {r["id"]: r["sims"] for r in SV.similarity_features(df, "v", L, 0.5, mixed=M).collect()}
    assert got[1] == pytest.approx(K[0] @ M) and got[2] is None
