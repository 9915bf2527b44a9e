"""Every fit and cost on rows with null, NaN and very large ids equals the
same call with those rows left out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import anomaly as AN
from keelson.operators import evaluate as EV
from keelson.operators import features as FT
from keelson.operators import gram as G
from keelson.operators import kmeans as KM
from keelson.operators import logistic as LG
from keelson.operators import network as NN
from keelson.operators import pca as PC
from keelson.operators import sparse_linear as SL
from keelson.operators import svm as SV

SCHEMA = "id long, x1 double, x2 double, y double, yb int, cls int, v array<double>, p double"
NAN = float("nan")
BIG = 900_000_000_000_000_000


def clean_rows():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(40):
        a, b = (float(t) for t in rng.standard_normal(2))
        yb = int(a + 0.5 * rng.standard_normal() > 0)
        rows.append((BIG + 7919 * i, a, b, 1 + 2 * a - b + 0.1 * float(rng.standard_normal()), yb, i % 3,
                     [a, b, float(rng.standard_normal())], float(math.exp(-a * a))))
    return rows


BAD = [(BIG + 1, None, 1.0, 2.0, 1, 0, None, None), (BIG + 2, NAN, 1.0, 2.0, 0, 1, [1.0, None, 2.0], NAN),
       (BIG + 3, 1.0, NAN, 2.0, 1, 2, [NAN, 1.0, 2.0], NAN), (BIG + 4, 1.0, None, NAN, None, None, None, None)]


def W():
    return [NN.init_fixed(2, 3), NN.init_fixed(3, 2)]


CASES = {
    "normalizer": lambda d: (lambda m: (m.mu, m.sigma))(FT.fit_normalizer(d, ["x1", "x2"])),
    "gram": lambda d: G.gram(d, ["x1", "x2"], "y"),
    "linear fit": lambda d: G.solve(G.gram(d, ["x1", "x2"], "y")),
    "ridge folds": lambda d: [(f["fold"], f["n"], list(f["theta"]), f["mse"]) for f in
                              EV.kfold_ridge(d, ["x1", "x2"], "y", EV.fold_of("id", 3), 3, 1.0)],
    "logistic cost": lambda d: d.agg(LG.cost_expr(["x1", "x2"], "yb", [0.1, 0.5, -0.5], 1.0)).first()[0],
    "logistic gradient": lambda d: sorted(tuple(r) for r in LG.gradient_frame(d, ["x1", "x2"], "yb", [0.1, 0.5, -0.5], 1.0).collect()),
    "logistic fit": lambda d: LG.fit(d, ["x1", "x2"], "yb", 1.0).theta,
    "one-vs-all": lambda d: [list(t) for t in LG.fit_one_vs_all(d, ["x1", "x2"], "cls", 1.0).thetas.values()],
    "fold logistic": lambda d: LG.fit_folds(d, ["x1", "x2"], "yb", EV.fold_of("id", 3), 3, 1.0)[0].log_loss(),
    "network cost": lambda d: (lambda r: (r[0], r[2], list(NN._flatten(r[1]))))(NN.cost_and_gradient(d, "v", "cls", W(), [0, 1, 2], 1.0)),
    "network training": lambda d: NN.train(d, "v", "cls", W(), [0, 1, 2], 1.0, 3).history,
    "k-means": lambda d: KM.fit(d, "v", 3, np.eye(3), 4).centroids,
    "second moment": lambda d: sorted(tuple(r) for r in PC.covariance_long(d, "v", 3).collect()),
    "gaussian": lambda d: AN.estimate_params(d, ["x1", "x2"]),
    "gaussian, full": lambda d: [a.tolist() for a in AN.estimate_covariance(d, ["x1", "x2"])],
    "threshold": lambda d: AN.best_threshold(d, "p", "yb"),
    "f1": lambda d: tuple(AN.f1_at(d, "p", "yb", 0.5).first()),
    "svm": lambda d: (lambda r: [*r[0], r[1]])(SV.fit_linear(d, "v", "yb", max_iter=20)),
    "learning curve": lambda d: EV.learning_curve(d, d, ["x1", "x2"], "y", ["id"], [10, 20]),
    "hinge": lambda d: sorted(tuple(r) for r in SL.fit_hinge(
        d.filter("v IS NOT NULL").select("id", F.posexplode("v").alias("term", "w")).filter("w IS NOT NULL AND NOT isnan(w)"),
        d.select("id", F.col("yb").alias("label")).filter("label IS NULL OR id % 7919 = {}".format(BIG % 7919)), id_col="id", iters=3)[0].collect()),
}


def flat(x):
    if isinstance(x, (list, tuple, np.ndarray)):
        return [v for y in x for v in flat(y)]
    return [float(x)]


@pytest.fixture(scope="module")
def tables(spark):
    clean = spark.createDataFrame(clean_rows(), SCHEMA).coalesce(2).persist()
    mixed = spark.createDataFrame([*clean_rows(), *BAD], SCHEMA).coalesce(2).persist()
    return clean, mixed


@pytest.mark.parametrize("name", CASES)
def test_bad_rows_take_no_part(tables, name):
    clean, mixed = (flat(CASES[name](t)) for t in tables)
    assert clean and all(map(math.isfinite, clean))
    assert mixed == pytest.approx(clean, rel=1e-9, abs=1e-12)


def test_linear_costs_of_bad_rows(tables):
    a, b = (G.cost(G.gram(t, ["x1", "x2"], "y"), np.array([1.0, 2.0, 0.5])) for t in tables)
    assert a == pytest.approx(b)


def test_large_and_odd_keys_have_folds(spark):
    df = spark.createDataFrame([(9_223_372_036_854_775_807, "a", 5.5), (-9_223_372_036_854_775_808, "b", None), (None, None, 1e300)],
                               "i long, s string, d double")
    for c in ("i", "s", "d"):
        got = [r[0] for r in df.select(EV.fold_of(c, 5)).collect()]
        want = [r[0] for r in df.select(F.col(c).isNull()).collect()]
        assert [g is None for g in got] == want and all(g is None or 0 <= g < 5 for g in got)
    assert EV.split(df, "s")[0].count() + EV.split(df, "s")[1].count() == 2
    small = spark.range(100)
    old = F.pmod(F.col("id") * 48271 + 17, F.lit(2_147_483_647))
    assert small.filter(old != FT.permutation_key("id")).count() == 0


def test_no_row_left_has_a_defined_result(spark, tables):
    none = tables[1].filter("p IS NULL OR isnan(p)")
    eps, f1 = AN.best_threshold(none, "p", "yb")
    assert math.isnan(eps) and f1 == 0.0
    grid = SV.grid_search(tables[0].select("v", "yb"), tables[0].limit(0).select("v", "yb"), "v", "yb", np.eye(3), [1.0], [1.0])
    assert grid == [(1.0, 1.0, float("inf"))]


def test_a_hinge_label_without_document_or_class_counts_nothing(spark):
    feats = spark.createDataFrame([(1, "a", 1.0), (1, "b", 0.5), (2, "b", 1.0), (3, "a", 0.3)], "doc_id long, term string, w double")
    plain = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    odd = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (77, 1)], "doc_id long, label int")
    one, two = (SL.fit_hinge(feats.join(plain.select("doc_id"), "doc_id", "left_semi") if i == 0 else feats, lab, iters=3)
                for i, lab in enumerate((plain, odd)))
    assert {r["term"]: r["weight"] for r in one[0].collect()} == pytest.approx({r["term"]: r["weight"] for r in two[0].collect()})
    assert one[1] == pytest.approx(two[1])
