"""Folds, prefixes and penalties that train in the same passes equal separate
fits; the line search keeps its history."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import logistic as LG
from keelson.operators import network as NN


def blobs(spark, n=240, classes=3, dims=3, seed=5):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    x = rng.standard_normal((n, dims)) + np.eye(classes, dims)[y] * 1.5
    rows = [(i, [float(v) for v in x[i]], int(y[i]), int(i * 7 % 4)) for i in range(n)]
    return x, y, np.array([r[3] for r in rows]), spark.createDataFrame(rows, "id long, x array<double>, y int, f int")


def test_fold_fits_equal_separate_fits(spark):
    x, y, f, df = blobs(spark)
    models, oof = LG.fit_folds(df, "x", "y", F.col("f"), 4, lam=1.0, keep=["id"])
    rows = {r["id"]: r for r in oof.collect()}
    assert len(rows) == len(y)
    loss = []
    for fold in range(4):
        one = LG.fit_one_vs_all(df.filter(F.col("f") != fold), "x", "y", lam=1.0)
        for c in range(3):
            assert models.thetas[fold][c] == pytest.approx(one.thetas[c], abs=1e-9)
        for i in np.flatnonzero(f == fold):
            p = 1 / (1 + np.exp(-np.array([one.thetas[c][0] + one.thetas[c][1:] @ x[i] for c in range(3)])))
            p /= p.sum()
            assert rows[i]["fold"] == fold and rows[i]["p"] == pytest.approx(p, abs=1e-9)
            loss.append(-np.log(p[y[i]]))
    assert models.log_loss() == pytest.approx(np.mean(loss), abs=1e-9)
    assert all(models.converged.values())


def test_two_classes_have_one_model_a_fold(spark):
    x, y, f, df = blobs(spark, 120, 2, 2)
    named = df.withColumn("y", F.when(F.col("y") == 1, "yes").otherwise("no"))
    schema = "id long, x array<double>, y string, f int"
    odd = named.unionByName(spark.createDataFrame([(1000, None, "yes", 0), (1001, [1.0, None], "no", 1),
                                                   (1002, [1.0, float("nan")], "no", 1), (1003, [1.0, 2.0], None, 1),
                                                   (1004, [1.0, 2.0], "yes", None)], schema))
    a, rows_a = LG.fit_folds(named, "x", "y", F.col("f"), 4, lam=0.5, keep=["id"])
    b, rows_b = LG.fit_folds(odd, "x", "y", F.col("f"), 4, lam=0.5, keep=["id"])
    assert a.classes == ["no", "yes"] and set(a.thetas[0]) == {1}
    assert rows_b.count() == rows_a.count() == 120
    for fold in range(4):
        assert a.thetas[fold][1] == pytest.approx(b.thetas[fold][1], abs=1e-12)
        one = LG.fit(df.filter(F.col("f") != fold), "x", "y", lam=0.5)
        assert a.thetas[fold][1] == pytest.approx(one.theta, abs=1e-9)
    assert all(sum(r["p"]) == pytest.approx(1.0) for r in rows_a.collect())


def separate(x, Y, W0, lam, iters, memory=5):
    """One network, one length after another, in numpy."""
    shapes = [w.shape for w in W0]

    def fg(v):
        W = NN._unflatten(v, shapes)
        loss, g = NN.loss_grad_np(x, Y, W)
        g = [a / len(x) for a in g]
        for a, w in zip(g, W):
            a[:, 1:] += lam / len(x) * w[:, 1:]
        return loss / len(x) + lam / (2 * len(x)) * sum((w[:, 1:] ** 2).sum() for w in W), NN._flatten(g)

    v = NN._flatten(W0)
    J, g = fg(v)
    hist, S, T = [J], [], []
    for _ in range(iters):
        q, al = g.copy(), []
        for s, t in reversed(list(zip(S, T))):
            al.append(s @ q / (t @ s))
            q -= al[-1] * t
        if S:
            q *= (S[-1] @ T[-1]) / (T[-1] @ T[-1])
        for (s, t), a in zip(zip(S, T), reversed(al)):
            q += s * (a - t @ q / (t @ s))
        d, step = -q, 1.0
        if g @ d >= 0:
            d, S, T = -g, [], []
        while True:
            Jn, gn = fg(v + step * d)
            if Jn <= J + 1e-4 * step * (g @ d) or step < 1e-8:
                break
            step /= 2
        s, t = step * d, gn - g
        if t @ s > 1e-12:
            S, T = (S + [s])[-memory:], (T + [t])[-memory:]
        v, J, g = v + s, Jn, gn
        hist.append(J)
    return NN._unflatten(v, shapes), hist


def start(scale=1.0):
    return [NN.init_fixed(4, 3) * scale, NN.init_fixed(3, 4) * scale]


def test_networks_in_lockstep_keep_their_histories(spark):
    x, y, _, df = blobs(spark, 150)
    rows = NN.training_rows(df, "x", "y", [0, 1, 2]).persist()
    Y = np.eye(3)[y]
    # the second starts far off, so that shorter steps are needed
    specs = [NN.Spec(start(), 1.0), NN.Spec(start(60.0), 0.0), NN.Spec(start(), 10.0)]
    got = NN.train_many(rows, specs, 3, max_iter=8)
    shorter = False
    for spec, res in zip(specs, got):
        W, hist = separate(x, Y, spec.W0, spec.lam, 8)
        assert [J for _, J in res.history] == pytest.approx(hist, rel=1e-8)
        for a, b in zip(res.weights, W):
            assert a == pytest.approx(b, rel=1e-5, abs=1e-7)
        shorter |= len(hist) > 1
    assert got[0].jobs <= 1 + 2 * 8
    rows.unpersist()


def test_learning_and_lambda_curves_equal_separate_fits(spark):
    x, y, f, df = blobs(spark, 200)
    train, val = df.filter("id < 150"), df.filter("id >= 150")
    Y = np.eye(3)[y]

    def plain(W, rows, lam):
        loss = NN.loss_np(x[rows], Y[rows], W)
        return loss / len(rows) + lam / (2 * len(rows)) * sum((w[:, 1:] ** 2).sum() for w in W)

    v = np.arange(150, 200)
    curve = NN.learning_curve(train, val, "x", "y", start(), [0, 1, 2], ["id"], [5, 20, 80, 5000], lam=1.0, max_iter=6)
    assert [c[0] for c in curve] == [5, 20, 80, 150]
    for size, a, b in curve:
        W, _ = separate(x[:size], Y[:size], start(), 1.0, 6)
        assert a == pytest.approx(plain(W, np.arange(size), 1.0), rel=1e-6)
        assert b == pytest.approx(plain(W, v, 1.0), rel=1e-6)
    for lam, a, b in NN.lambda_curve(train, val, "x", "y", start(), [0, 1, 2], [0.0, 0.1, 3.0], max_iter=6):
        W, _ = separate(x[:150], Y[:150], start(), lam, 6)
        assert a == pytest.approx(plain(W, np.arange(150), 0.0), rel=1e-6)
        assert b == pytest.approx(plain(W, v, 0.0), rel=1e-6)
    none = df.limit(0)
    assert NN.learning_curve(none, val, "x", "y", start(), [0, 1, 2], ["id"], [5]) == []


def test_unusable_rows_take_no_part_in_networks(spark):
    x, y, _, df = blobs(spark, 60)
    odd = df.unionByName(spark.createDataFrame([(900, None, 1, 0), (901, [1.0, None, 2.0], 1, 0),
                                                (902, [1.0, float("nan"), 2.0], 0, 0), (903, [1.0, 2.0, 3.0], None, 0)], df.schema))
    a, b = (NN.cost_and_gradient(d, "x", "y", start(), [0, 1, 2], 1.0) for d in (df, odd))
    assert a[2] == b[2] == 60 and a[0] == pytest.approx(b[0], rel=1e-12)
    assert NN._flatten(a[1]) == pytest.approx(NN._flatten(b[1]), abs=1e-12)
    out = {r["id"]: r["a"] for r in NN.forward(odd, "x", start(), ["id"]).collect()}
    assert len(out) == 64 and out[900] is out[901] is out[902] is None and len(out[903]) == 3
    pred = {r["id"]: r["pred"] for r in NN.predict(odd, "x", start(), [0, 1, 2], ["id"]).collect()}
    assert pred[900] is None and pred[0] in (0, 1, 2)
