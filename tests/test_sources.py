"""Sources and sinks (S1, S3-S7, S10), object wrappers (C8, N9) and small
row-shaping operators (P4, P5, P8, P13, K7) on fixtures written to scratch."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import features as FT
from keelson.operators import kmeans as KM
from keelson.operators import logistic as LG
from keelson.operators import network as NN
from keelson.operators import recommend as RC
from keelson.sources import readers, writers


def test_numeric_csv_and_vocab(spark, scratch):
    with open(f"{scratch}/houses.txt", "w") as fh:
        fh.write("2104,3,399900\n1600,3,329900\n2400,3,369000\n1416,2,232000\n")
    df = readers.read_numeric_csv(spark, f"{scratch}/houses.txt", ["area", "rooms", "price"])
    assert df.count() == 4 and dict(df.dtypes)["price"] == "double"
    with open(f"{scratch}/vocab.txt", "w") as fh:
        fh.write("1\taa\n2\tab\n3\tabil\n")
    v = readers.read_vocab(spark, f"{scratch}/vocab.txt").collect()
    assert [(r["idx"], r["word"]) for r in v] == [(1, "aa"), (2, "ab"), (3, "abil")]


def test_item_names_and_whole_text(spark, scratch):
    with open(f"{scratch}/items.txt", "w") as fh:
        fh.write("1 Toy Story (1995)\n2 GoldenEye (1995) \n")
    names = readers.read_item_names(spark, f"{scratch}/items.txt").orderBy("item_id").collect()
    assert [(r.item_id, r.title) for r in names] == [(1, "Toy Story (1995)"), (2, "GoldenEye (1995)")]
    os.makedirs(f"{scratch}/mail")
    for n, body in [("a.txt", "line one\nline two\n"), ("b.txt", "x")]:
        with open(f"{scratch}/mail/{n}", "w") as fh:
            fh.write(body)
    t = {os.path.basename(r.path): r.text for r in readers.read_text_files(spark, f"{scratch}/mail").collect()}
    assert t == {"a.txt": "line one\nline two\n", "b.txt": "x"}


def test_labelled_tree_with_exact_cap(spark, scratch):
    for cat, n in [("ALB", 5), ("BET", 2), ("DOL", 4)]:
        os.makedirs(f"{scratch}/train/{cat}")
        for i in range(n):
            with open(f"{scratch}/train/{cat}/img_{i}.jpg", "wb") as fh:
                fh.write(bytes([i, 1, 2]))
    df = readers.read_labelled_tree(spark, f"{scratch}/train", limit_per_class=3)
    got = sorted((r.category, r.label, r.name) for r in df.collect())
    assert [g[:2] for g in got].count(("ALB", 0)) == 3
    assert [g[:2] for g in got].count(("BET", 1)) == 2
    assert [g[:2] for g in got].count(("DOL", 2)) == 3


def test_json_fields_and_build(spark):
    df = spark.createDataFrame([(1, '{"k": 69}'), (2, '{"k": 5}')], "id long, props string")
    assert [r.k for r in readers.json_fields(df, "props", "k int", keep=["id"]).orderBy("id").collect()] == [69, 5]
    j = readers.to_json_column(df, ["id"], out="j").orderBy("j").collect()
    assert [r.j for r in j] == ['{"id":1}', '{"id":2}']


def test_model_round_trip_and_submission(spark, scratch):
    m = FT.Normalizer(["a", "b"], [1.0, 2.0], [0.5, 0.0])
    writers.save_model(m.table(spark), f"{scratch}/norm")
    back = writers.load_model(spark, f"{scratch}/norm").orderBy("feature").collect()
    assert [(r.feature, r.mu, r.sigma) for r in back] == [("a", 1.0, 0.5), ("b", 2.0, 0.0)]
    probs = spark.createDataFrame([(1, "A", 0.2), (1, "B", 0.8), (2, "A", 0.6), (2, "B", 0.4)],
                                  "id long, class string, p double")
    frame = writers.submission_frame(probs, "id", "class", "p", ["A", "B"])
    path = writers.write_submission(frame, scratch, "test")
    out = spark.read.option("header", "true").csv(path).orderBy("id").collect()
    assert [(r.id, r.A, r.B) for r in out] == [("1", "0.2", "0.8"), ("2", "0.6", "0.4")]


def test_relabel_binarize_explode_append_members(spark):
    df = spark.createDataFrame([(1, 10, [1.0, 2.0]), (2, 3, [3.0, 4.0])], "id long, y int, x array<double>")
    out = df.select(FT.relabel("y", {10: 0}).alias("y2"), FT.binarize("y", 3).alias("b")).collect()
    assert [(r.y2, r.b) for r in out] == [(0, 0.0), (3, 1.0)]
    long = FT.explode_features(df, "id", "x")
    back = {r.id: r.features for r in FT.implode_features(long, "id").collect()}
    assert back == {1: [1.0, 2.0], 2: [3.0, 4.0]}
    r1 = spark.createDataFrame([(1, 1, 5.0)], "user long, item long, rating double")
    r2 = spark.createDataFrame([(9, 1, 4.0)], "user long, item long, rating double")
    assert RC.append_ratings(r1, r2).count() == 2
    a = KM.assign(df, "x", np.array([[1.0, 2.0], [3.0, 4.0]]))
    assert [r.id for r in KM.members(a, 1).collect()] == [2]


def test_binary_classifier_object(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(200, 2))
    y = ((X[:, 0] ** 2 + X[:, 1] ** 2) < 1.0).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(X, y)],
                               "a double, b double, y int")
    clf = LG.BinaryClassifier(["a", "b"], "y", degree=2, lam=0.1).fit(df)
    assert clf.accuracy(df) > 90.0
    scored = clf.classify(df, keep=["y"]).first()
    assert 50.0 <= scored["confidence"] <= 100.0


def test_network_object_trains(spark):
    rng = np.random.default_rng(12)
    X = rng.normal(size=(120, 2))
    lab = (X[:, 0] > 0).astype(int)
    df = spark.createDataFrame([([float(a), float(b)], int(c)) for (a, b), c in zip(X, lab)],
                               "x array<double>, label int")
    net = NN.NeuralNetwork([2, 4, 2], lam=0.1, seed=1).fit(df, "x", "label", max_iter=15)
    assert net.history[-1][1] < net.history[0][1]
    p = net.predict(df, "x", ["label"])
    acc = p.agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
    assert acc > 0.9


@pytest.mark.parametrize("hidden", ["tanh"])
def test_tanh_hidden_gradient(spark, hidden):
    rng = np.random.default_rng(13)
    X = rng.normal(size=(20, 2))
    lab = rng.integers(0, 2, size=20)
    W = [NN.init_fixed(3, 2), NN.init_fixed(2, 3)]
    Y = NN._one_hot(lab, [0, 1])
    _, g = NN.loss_grad_np(X, Y, W, hidden)
    shapes = [w.shape for w in W]
    num = NN.numeric_gradient(lambda v: NN.loss_grad_np(X, Y, NN._unflatten(v, shapes), hidden)[0],
                              NN._flatten(W))
    assert NN._flatten(g) == pytest.approx(num, abs=1e-6)
