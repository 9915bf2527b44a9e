"""Model operators against brute force / closed forms on small fixtures,
and against the reference's documented values where its data is known."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import anomaly as AN
from keelson.operators import evaluate as EV
from keelson.operators import gram as G
from keelson.operators import indexing as IX
from keelson.operators import kmeans as KM
from keelson.operators import linear as LR
from keelson.operators import logistic as LG
from keelson.operators import network as NN
from keelson.operators import pca as PC
from keelson.operators import recommend as RC
from keelson.operators import sparse_linear as SL

HOUSES = [(2104.0, 3.0, 399900.0), (1600.0, 3.0, 329900.0), (2400.0, 3.0, 369000.0),
          (1416.0, 2.0, 232000.0)]


def _houses(spark):
    return spark.createDataFrame(HOUSES, "area double, rooms double, price double")


def test_cost_and_normal_equation_documented_values(spark):
    df = _houses(spark)
    theta = list(1e4 * np.array([8.959790954478693, 0.013921067401755, -0.873801911287263]))
    J = LR.cost_frame(df, ["area", "rooms"], "price", theta, lam=0.0).first()["J"]
    assert J == pytest.approx(7.522274051241411e8, rel=1e-12)
    theta = LR.fit_normal(df, ["area", "rooms"], "price")
    assert theta == pytest.approx(1e4 * np.array([-4.698317251656216, 0.005848790585483,
                                                  9.808214891250811]), rel=1e-6)


def test_gradient_descent_reaches_normal_equation(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 2))
    y = 3 + X @ [1.5, -2.0] + rng.normal(scale=0.1, size=300)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(X, y)],
                               "a double, b double, y double")
    Gm = G.gram(df, ["a", "b"], "y")
    path = LR.gradient_descent(Gm, 0.3, 500)
    assert path[-1][2] == pytest.approx(G.solve(Gm), abs=1e-6)
    assert all(b[1] <= a[1] + 1e-12 for a, b in zip(path, path[1:]))
    grad = {r["idx"]: r["grad"] for r in LR.gradient_frame(df, ["a", "b"], "y", [1, 1, 1], 2.0).collect()}
    assert [grad[i] for i in range(3)] == pytest.approx(G.gradient(Gm, np.ones(3), 2.0), rel=1e-9)


def test_logistic_newton_matches_gradient_zero(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(400, 2))
    p = 1 / (1 + np.exp(-(0.5 + X @ [2.0, -1.0])))
    y = (rng.uniform(size=400) < p).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(X, y)],
                               "a double, b double, y double")
    m = LG.fit(df, ["a", "b"], "y", lam=1.0)
    g = [r["grad"] for r in LG.gradient_frame(df, ["a", "b"], "y", list(m.theta), 1.0)
         .orderBy("idx").collect()]
    assert np.max(np.abs(g)) < 1e-8
    num = LG.numeric_gradient_frame(df, ["a", "b"], "y", [0.1, 0.2, 0.3], 1.0).collect()
    for r in num:
        assert r["numeric"] == pytest.approx(r["analytic"], abs=1e-8)


def test_one_vs_all_equals_separate_fits(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(300, 2))
    lab = np.argmax(X @ np.array([[1, -1, 0.2], [0.3, 1, -1]]), axis=1)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(X, lab)],
                               "a double, b double, c int")
    ova = LG.fit_one_vs_all(df, ["a", "b"], "c", lam=1.0)
    for c in ova.classes:
        single = LG.fit(df.withColumn("y", (F.col("c") == c).cast("double")), ["a", "b"], "y", lam=1.0)
        assert ova.thetas[c] == pytest.approx(single.theta, abs=1e-7)


def test_kmeans_brute_force(spark):
    rng = np.random.default_rng(4)
    pts = np.vstack([rng.normal(loc=c, scale=0.3, size=(40, 2)) for c in ([0, 0], [5, 5], [0, 5])])
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)],
                               "id long, x array<double>")
    init = pts[[0, 40, 80]]
    res = KM.fit(df, "x", 2, init, max_iters=5, tol=None)
    c = init.copy()
    for _ in range(5):
        d = ((pts[:, None, :] - c[None, :, :]) ** 2).sum(-1)
        k = d.argmin(1)
        c = np.array([pts[k == j].mean(0) if np.any(k == j) else c[j] for j in range(3)])
    assert res.centroids == pytest.approx(c, abs=1e-9)
    # labels belong to the returned centroids, and so does the last cohesion
    got = {r["id"]: (r["k"], r["d2"]) for r in KM.assign(df, "x", res.centroids).collect()}
    d = ((pts[:, None, :] - res.centroids[None, :, :]) ** 2).sum(-1)
    assert [got[i][0] for i in range(len(pts))] == d.argmin(1).tolist()
    own = [d[d.argmin(1) == j, j].mean() for j in range(3)]
    assert res.history[-1][1] == pytest.approx(np.mean(own))
    # rows without a complete vector take no part and have no cluster
    holes = df.unionByName(spark.createDataFrame([(900, None), (901, [1.0, None]), (902, [float("nan"), 0.0])],
                                                 "id long, x array<double>"))
    again = KM.fit(holes, "x", 2, init, max_iters=5, tol=None)
    assert again.centroids == pytest.approx(res.centroids, abs=1e-9)
    assert {r["k"] for r in KM.assign(holes, "x", init).filter("id >= 900").collect()} == {None}
    # hundreds of centroids run the same way
    wide = np.random.default_rng(1).normal(size=(300, 2))
    d = ((pts[:, None, :] - wide[None, :, :]) ** 2).sum(-1)
    assert [r["k"] for r in KM.assign(df, "x", wide).orderBy("id").collect()] == d.argmin(1).tolist()


def test_pca_exercise_like_values(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(200, 2)) @ np.array([[2.0, 1.0], [1.0, 1.0]])
    Xn = (X - X.mean(0)) / X.std(0)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in Xn], "a double, b double")
    m = PC.directions(PC.covariance(df, ["a", "b"]))
    S, U = np.linalg.eigh(Xn.T @ Xn / 200)
    assert sorted(m.S, reverse=True) == pytest.approx(sorted(S, reverse=True))
    assert abs(m.U[:, 0] @ U[:, np.argmax(S)]) == pytest.approx(1.0)
    assert m.U[0, 0] > 0
    cost = PC.cost(df, ["a", "b"], m, 2).first()["cost"]
    assert cost == pytest.approx(0.0, abs=1e-20)


def test_best_threshold_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    p = np.concatenate([rng.uniform(0, 0.02, 30), rng.uniform(0, 1, 300)])
    y = np.concatenate([np.ones(30), (rng.uniform(size=300) < 0.05)]).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, y int")
    eps, f1 = AN.best_threshold(df, "p", "y")
    lo, hi = p.min(), p.max()
    step = (hi - lo) / 1000
    best_e, best_f = 0.0, 0.0
    for i in range(1000):
        e = lo + i * step
        pred = p < e
        tp, fp, fn = np.sum(pred & (y == 1)), np.sum(pred & (y == 0)), np.sum(~pred & (y == 1))
        pr = tp / (tp + fp) if tp + fp else 0.0
        rc = tp / (tp + fn) if tp + fn else 0.0
        f = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        if f > best_f:
            best_e, best_f = e, f
    assert f1 == pytest.approx(best_f) and eps == pytest.approx(best_e)


def test_global_row_index_and_top_k(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("k"))
    idx = IX.global_row_index(df, ["k"], name="rn")
    rows = sorted((r["k"], r["rn"]) for r in idx.collect())
    assert [rn for _, rn in rows] == list(range(1, 5001))
    g = spark.range(0, 3000).select((F.col("id") % 3).alias("g"), F.col("id"))
    top = IX.top_k_per_group(g, ["g"], [F.col("id").desc()], 2).collect()
    assert sorted((r["g"], r["id"]) for r in top) == [(0, 2994), (0, 2997), (1, 2995), (1, 2998),
                                                       (2, 2996), (2, 2999)]


def test_kfold_and_curves_match_direct_refits(spark):
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 10, 500)
    y = 2 + 0.5 * x + rng.normal(size=500)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))],
                               "id long, x double, y double")
    fold = EV.fold_of("id", 5)
    folds = EV.kfold_ridge(df, ["x"], "y", fold, 5, lam=3.0)
    fid = np.array([r[0] for r in df.select(fold).collect()])
    for f in folds:
        tr = fid != f["fold"]
        A = np.c_[np.ones(tr.sum()), x[tr]]
        th = np.linalg.solve(A.T @ A + np.diag([0, 3.0]), A.T @ y[tr])
        assert f["theta"] == pytest.approx(th, rel=1e-9)
    train, val = EV.split(df, "id")
    curve = EV.learning_curve(train, val, ["x"], "y", ["id"], [10, 50, 100])
    tr_rows = sorted((r["id"], r["x"], r["y"]) for r in train.collect())
    for s, jt, _ in curve:
        sub = np.array(tr_rows[:s])
        A = np.c_[np.ones(s), sub[:, 1]]
        th = np.linalg.lstsq(A, sub[:, 2], rcond=None)[0]
        assert jt == pytest.approx(np.sum((A @ th - sub[:, 2]) ** 2) / (2 * s), rel=1e-8)


def test_network_gradient_matches_numeric(spark):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(30, 3))
    lab = rng.integers(0, 3, size=30)
    df = spark.createDataFrame([([float(v) for v in a], int(b)) for a, b in zip(X, lab)],
                               "x array<double>, label int")
    W = [NN.init_fixed(5, 3), NN.init_fixed(3, 5)]
    J, grads, _ = NN.cost_and_gradient(df, "x", "label", W, [0, 1, 2], lam=3.0)
    shapes = [w.shape for w in W]

    def f(v):
        Ws = NN._unflatten(v, shapes)
        Y = NN._one_hot(lab, [0, 1, 2])
        loss, _ = NN.loss_grad_np(X, Y, Ws)
        reg = sum(float(np.sum(w[:, 1:] ** 2)) for w in Ws)
        return loss / 30 + 3.0 / 60 * reg

    num = NN.numeric_gradient(f, NN._flatten(W))
    assert NN._flatten(grads) == pytest.approx(num, abs=1e-9)
    assert J == pytest.approx(f(NN._flatten(W)), rel=1e-12)


def test_logical_and_layer(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 1.0])], "id int, x array<double>")
    W = [np.array([[-30.0, 20.0, 20.0]])]
    out = {r["id"]: r["a"][0] for r in NN.forward(df, "x", W, ["id"]).collect()}
    assert round(out[1]) == 0 and round(out[2]) == 1


def test_als_decreases_exact_cost(spark):
    rng = np.random.default_rng(9)
    rows = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(30) for i in range(20)
            if rng.uniform() < 0.4]
    rt = spark.createDataFrame(rows, "user long, item long, rating double")
    X = rt.select("item").distinct().select("item", *[(F.sin(F.col("item") + f) / 10).alias(f"x{f}")
                                                      for f in range(2)])
    T = rt.select("user").distinct().select("user", *[(F.cos(F.col("user") + f) / 10).alias(f"t{f}")
                                                      for f in range(2)])
    J0 = RC.cost(rt, X, T, 2, 1.5).first()["J"]
    _, _, hist = RC.train_als(rt, X, T, 2, 1.5, iters=3)
    assert hist[0][1] < J0 and all(b[1] <= a[1] + 1e-9 for a, b in zip(hist, hist[1:]))


def test_sparse_hinge_objective_decreases(spark):
    rows, labels = [], []
    rng = np.random.default_rng(10)
    for d in range(60):
        y = d % 2
        labels.append((d, y))
        for t in range(5):
            term = f"t{t + (5 if y else 0)}" if rng.uniform() < 0.8 else f"t{rng.integers(0, 10)}"
            rows.append((d, term, 1.0))
    feats = spark.createDataFrame(rows, "doc_id long, term string, w double") \
        .groupBy("doc_id", "term").agg(F.sum("w").alias("w"))
    lab = spark.createDataFrame(labels, "doc_id long, label int")
    w, b, hist = SL.fit_hinge(feats, lab, alpha=0.01, iters=6)
    assert hist[-1][1] < hist[0][1]
    pred = SL.decision(feats, w, b, lab).join(lab, "doc_id")
    acc = pred.agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.8


def test_sparse_hinge_matches_dense_iterations(spark):
    """Brute force: the same subgradient steps on a dense numpy matrix
    give the same weights, bias and objective history."""
    from keelson.operators import sparse_linear as SL
    rng = np.random.default_rng(21)
    m, V, alpha, iters = 40, 8, 0.05, 5
    X = np.where(rng.uniform(size=(m, V)) < 0.4, rng.integers(1, 4, size=(m, V)), 0).astype(float)
    X[:, 0] = np.maximum(X[:, 0], 1.0)          # every term column and doc has a value
    X[0, :] = np.maximum(X[0, :], 1.0)
    lab = (X[:, 1] + X[:, 2] > X[:, 3] + 1).astype(int)
    rows = [(i, f"t{j}", float(X[i, j])) for i in range(m) for j in range(V) if X[i, j] != 0]
    feats = spark.createDataFrame(rows, "doc_id long, term string, w double")
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(lab)], "doc_id long, label int")
    w_df, b, hist = SL.fit_hinge(feats, labels, alpha=alpha, iters=iters)
    y = np.where(lab > 0, 1.0, -1.0)
    w, bb, t0, ref = np.zeros(V), 0.0, 1.0 / alpha, []
    for t in range(1, iters + 1):
        mg = X @ w + bb
        act = y * mg < 1.0
        ref.append(np.maximum(0.0, 1.0 - y * mg).mean() + alpha / 2.0 * (w @ w))
        g = -(y[act, None] * X[act]).sum(0)
        eta = 1.0 / (alpha * (t + t0))
        w = w - eta * (alpha * w + g / m)
        bb = bb - eta * float(-y[act].sum()) / m
    got = {r["term"]: r["weight"] for r in w_df.collect()}
    assert np.allclose([got[f"t{j}"] for j in range(V)], w, rtol=1e-9, atol=1e-12)
    assert b == pytest.approx(bb, rel=1e-9, abs=1e-12)
    assert np.allclose([h[1] for h in hist], ref, rtol=1e-9)


def test_svm_learns_separable_and_circle_data(spark):
    from keelson.operators import svm as SV
    rng = np.random.default_rng(14)
    X = rng.uniform(-1, 1, size=(300, 2))
    y_lin = (X[:, 0] + 0.5 * X[:, 1] > 0.1).astype(int)
    y_circ = ((X ** 2).sum(1) < 0.4).astype(int)
    df = spark.createDataFrame([([float(a), float(b)], int(c), int(d))
                                for (a, b), c, d in zip(X, y_lin, y_circ)],
                               "x array<double>, yl int, yc int")
    w, b = SV.fit_linear(df, "x", "yl", C=10.0)
    pred = (X @ w + b >= 0).astype(int)
    assert (pred == y_lin).mean() > 0.95
    L = X[:40]
    w2, b2 = SV.fit_rbf(df, "x", "yc", L, sigma=0.5, C=10.0)
    S = np.exp(-((X[:, None, :] - L[None]) ** 2).sum(-1) / (2 * 0.25))
    assert ((S @ w2 + b2 >= 0).astype(int) == y_circ).mean() > 0.9


def test_kernel_rows_are_computed_once_for_all_sigmas(spark, monkeypatch):
    import pyarrow as pa
    from keelson.operators import svm as SV
    monkeypatch.setattr(SV, "SLICE", 3)
    rng = np.random.default_rng(4)
    X, L, sigmas = rng.normal(size=(8, 2)), rng.normal(size=(3, 2)), [0.5, 2.0]
    maps = [None, rng.normal(size=(3, 2))]
    got = SV.kernel_values(pa.array([None, *X.tolist(), None], pa.list_(pa.float64())), L, sigmas, maps).to_pylist()
    K = [np.exp(-((X[:, None] - L[None]) ** 2).sum(axis=2) / (2 * s * s)) for s in sigmas]
    assert got[0] is None and got[-1] is None
    assert np.allclose(got[1:-1], np.hstack([K[0], K[1] @ maps[1]]), atol=1e-12)
    with pytest.raises(ValueError):
        SV.kernel_values(pa.array([[1.0, 2.0], [1.0, 2.0, 3.0], [1.0]]), L, sigmas, maps)
    rows = [(v.tolist(), int(v[0] > 0)) for v in X] + [(None, 1), ([1.0, float("nan")], 0), ([1.0, None], 1), ([1.0, 2.0], None)]
    df = spark.createDataFrame(rows, "x array<double>, y int")
    kernel = SV._kernel_rows(df, "x", "y", L, sigmas, [np.eye(3), maps[1]])
    assert kernel._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    have = {tuple(np.round(r["_x"], 9)): r["_y"] for r in kernel.collect()}
    want = {tuple(np.round(np.r_[K[0][i], K[1][i] @ maps[1]], 9)): 1.0 if X[i, 0] > 0 else -1.0 for i in range(8)}
    assert have == want
