"""Many sparse models in one pass against separate fits in numpy."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import many_sparse as MS
from keelson.operators import sparse_linear as SL
from keelson.operators import text as TX

WORDS = ["".join(random.Random(i).choices("abcdeilmnorstu", k=3 + i % 4)) for i in range(40)]


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = ["x", "y", "z"][i % 3]
        pool = WORDS[10 * (i % 3):10 * (i % 3) + 20]
        rows.append((i, " ".join(rng.choices(pool, k=rng.randint(3, 25))), label, i % 4))
    rows += [(900, "", "x", 0), (901, None, "y", 1), (902, "only words nobody shares zzzz", None, 2), (903, "a ! b", "z", None)]
    return rows


def terms_of(text, low, high):
    w = re.findall(r"[^\W]{2,}", (text or "").lower())
    return [" ".join(w[i:i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]


def brute(rows, setting, fold, classes, iters, min_df):
    """(terms, W, b, margins of all rows) of one setting's models by dense steps."""
    rows = [r for r in rows if r[2] is not None]
    train = np.array([fold is None or r[3] != fold for r in rows])
    each = [terms_of(r[1], setting.low, setting.high) for r in rows]
    df = {}
    for t, on in zip(each, train):
        for x in set(t):
            df[x] = df.get(x, 0) + bool(on)
    vocab = sorted(x for x, c in df.items() if c >= min_df)
    at = {x: i for i, x in enumerate(vocab)}
    X = np.zeros((len(rows), len(vocab)))
    for i, t in enumerate(each):
        for x in t:
            if x in at:
                X[i, at[x]] += 1
    if setting.use_idf:
        X *= np.array([np.log((1 + train.sum()) / (1 + df[x])) + 1 for x in vocab])
    norm = np.sqrt((X * X).sum(axis=1))
    X /= np.where(norm > 0, norm, 1)[:, None]
    positives = classes[1:] if len(classes) == 2 else classes
    Y = np.array([[1.0 if r[2] == c else -1.0 for c in positives] for r in rows])
    W, b, a = np.zeros((len(vocab), len(positives))), np.zeros(len(positives)), setting.alpha
    for t in range(1, iters + 1):
        on = train[:, None] & (Y * (X @ W + b) < 1)
        c = np.where(on, -Y, 0)
        rate = 1 / (a * (t + 1 / a))
        W, b = W - rate * (a * W + X.T @ c / train.sum()), b - rate * c.sum(axis=0) / train.sum()
    return vocab, W, b, {r[0]: s for r, s in zip(rows, X @ W + b)}


def frames(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, f int")
    return TX.ngram_counts(docs, "doc_id", "text", 1, 2), docs.select("doc_id", "label", "f")


def test_settings_classes_and_folds_equal_separate_fits(spark):
    rows = [r for r in corpus() if r[3] is not None]
    counts, labels = frames(spark, rows)
    settings = [MS.Setting(1, h, idf, True, a) for h, idf, a in itertools.product((1, 2), (True, False), (1e-2, 1e-3))]
    many = MS.fit(MS.prepare(counts, labels, settings, folds=4, fold="f", min_df=2), iters=4)
    got = {}
    for r in many.table().collect():
        got.setdefault((r["setting"], r["fold"], r["class"]), {})[r["term"]] = r["weight"]
    held = {(r["doc_id"], r["setting"]): r for r in MS.predictions(many, held_out=True).collect()}
    acc = {r["setting"]: r for r in MS.grid(many).collect()}
    classes = ["x", "y", "z"]
    for i, s in enumerate(settings):
        hits = n = 0
        for f in range(4):
            vocab, W, b, m = brute(rows, s, f, classes, 4, 2)
            for k, c in enumerate(classes):
                mine = got[i, f, c]
                assert mine[None] == pytest.approx(b[k], abs=1e-12)
                want = dict(zip(vocab, W[:, k]))
                for t in set(mine) - {None}:
                    assert mine[t] == pytest.approx(want.get(t, 0.0), abs=1e-12)
                assert all(w == pytest.approx(mine.get(t, 0.0), abs=1e-12) for t, w in want.items())
            for r in rows:
                if r[2] is not None and r[3] == f:
                    p = held[r[0], i]
                    assert p["fold"] == f and p["truth"] == r[2] and p["score"] == pytest.approx(m[r[0]].max(), abs=1e-12)
                    top = np.sort(m[r[0]])
                    if top[-1] - top[-2] > 1e-9:
                        assert p["pred"] == classes[int(m[r[0]].argmax())]
                    hits += p["pred"] == r[2]
                    n += 1
        assert acc[i]["n"] == n and acc[i]["accuracy"] == pytest.approx(hits / n)
    assert sum(r["best"] for r in acc.values()) == 1
    best = max(acc.values(), key=lambda r: (r["accuracy"], -r["setting"]))
    assert best["best"]


def test_one_model_equals_the_hinge_trainer(spark):
    rows = [(i, t, "p" if l == "x" else "a", f) for i, t, l, f in corpus() if l is not None and terms_of(t, 1, 1)]
    counts, labels = frames(spark, rows)
    w = TX.tfidf(counts, len(rows))
    zero_one = labels.select("doc_id", (F.col("label") == "p").cast("int").alias("label"))
    weights, bias, _ = SL.fit_hinge(w, zero_one, alpha=1e-2, iters=5)
    many = MS.fit(MS.prepare(w, zero_one, [MS.Setting(1, 9, False, False, 1e-2)], n="w"), iters=5)
    mine = {r["term"]: r["weight"] for r in many.table().collect()}
    assert mine.pop(None) == pytest.approx(bias, abs=1e-12)
    assert mine == pytest.approx({r["term"]: r["weight"] for r in weights.collect()}, abs=1e-12)


def test_odd_labels_and_rows(spark):
    counts, labels = frames(spark, corpus())
    twice = labels.unionByName(labels).unionByName(spark.createDataFrame([(None, "x", 0), (7777, "y", 1)], labels.schema))
    one = MS.fit(MS.prepare(counts, labels.unionByName(spark.createDataFrame([(7777, "y", 1)], labels.schema)), [MS.Setting()]), iters=3)
    two = MS.fit(MS.prepare(counts, twice, [MS.Setting()]), iters=3)
    key = lambda m: sorted((str(r["term"]), r["class"], round(r["weight"], 12)) for r in m.table().collect())
    assert key(one) == key(two)
    p = {r["doc_id"]: r for r in MS.predictions(two).collect()}
    assert 902 not in p and 900 in p and p[900]["truth"] == "x"
    none = MS.prepare(counts.limit(0), labels.limit(0), [MS.Setting()])
    assert MS.fit(none, 2).models == [] and MS.predictions(none).count() == 0


def test_steps_can_go_on(spark):
    counts, labels = frames(spark, corpus(30))
    m = MS.prepare(counts, labels, [MS.Setting(1, 1)])
    a = MS.fit(m, 4)
    b = MS.fit(MS.fit(m, 2), 2, start=2)
    key = lambda m: sorted((str(r["term"]), r["class"], round(r["weight"], 12)) for r in m.table().collect())
    assert key(a) == key(b)
    assert (b.losses() < 1).all()
