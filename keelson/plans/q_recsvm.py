"""Collaborative filtering (R1-R6) on ratings derived from orders x
lineitem (user = customer, item = part, rating = mean of ceil(quantity /
10)), and support vector machines (V1-V5, F7/V4) on the embeddings with
the binary target label < 5."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from keelson.functions.expr import array_dot
from keelson.operators import blocked_als as BA
from keelson.operators import evaluate as EV
from keelson.operators import recommend as RC
from keelson.operators import svm as SV
from keelson.plans.base import query, r, rs, table
from keelson.plans.data import EMB_DIMS, emb
from keelson.session import cut_lineage, cut_partitioned

K = 3
LAM = 1.5

_R = ("r AS (SELECT o_custkey AS user_id, l_partkey AS item_id, avg(ceil(l_quantity / 10.0)) AS rating "
      "FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey)")


def _xs(c):
    return [f"sin({c} * {K} + {f + 1}) / 10.0" for f in range(K)]


def _ts(c):
    return [f"cos({c} * {K} + {f + 1}) / 10.0" for f in range(K)]


def ratings(spark, sf):
    """The ratings table, written once for all that a query does with it."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.ceil(F.col("l_quantity") / 10.0).alias("tens"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.avg("tens").alias("rating"))
            .transform(cut_lineage))


def ratings_by_item(spark, sf):
    """The same ratings dealt to blocks by item (columns ``ITEM_PLACE``) in the one
    shuffle that brings a pair's rows together, written once, and the number of
    blocks.  Which items to cut is told from lineitem alone."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.ceil(F.col("l_quantity") / 10.0).alias("tens"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    blocks = BA.blocks_of(li, li.count())
    parts = BA.parts_of(li, "l_partkey", "l_orderkey").withColumnRenamed("l_partkey", "item_id")
    rows = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), "tens")
    rows, _ = BA.placed(rows, "item_id", "user_id", blocks, "item", parts)
    rt = (rows.repartition(blocks, "item_block").groupBy("item_block", "item_id", "item_part", "user_id")
          .agg(F.avg("tens").alias("rating")))
    return cut_partitioned(rt, blocks, "item_block", order=("item_id", "item_part")), blocks


def init_factors(rt, users=None):
    """Deterministic starting factors, a function of the ids.  ``users``: a smaller
    table with the same user ids."""
    X = rt.select("item_id").distinct().select(
        "item_id", *[(F.sin(F.col("item_id") * K + (f + 1)) / 10.0).alias(f"x{f}") for f in range(K)])
    T = (rt if users is None else users).select("user_id").distinct().select(
        "user_id", *[(F.cos(F.col("user_id") * K + (f + 1)) / 10.0).alias(f"t{f}") for f in range(K)])
    return X, T


@query("item_mean", sql=f"""
WITH {_R} SELECT item_id, {rs('avg(rating)', 8)} AS mean_rating, count(*) AS n FROM r GROUP BY item_id""")
def item_mean(spark, sf):
    """Mean rating of every item over the users who rated it."""
    m = RC.item_mean(ratings(spark, sf), item="item_id")
    return m.select("item_id", r("mean_rating", 8).alias("mean_rating"), "n")


@query("ratings_normalise", sql=f"""
WITH {_R}, m AS (SELECT item_id, avg(rating) AS mu FROM r GROUP BY item_id)
SELECT r.user_id, r.item_id, r.rating, {rs('r.rating - m.mu', 8)} AS norm
FROM r JOIN m ON m.item_id = r.item_id""")
def ratings_normalise(spark, sf):
    """R2: mean normalisation of the ratings per item."""
    n = RC.normalise(ratings(spark, sf), item="item_id", user="user_id")
    return n.select("user_id", "item_id", "rating", r("norm", 8).alias("norm"))


@query("ratings_append", sql=f"""
WITH {_R}, n AS (SELECT -1 AS user_id, p_partkey AS item_id, 5.0 AS rating FROM part WHERE p_size = 1)
SELECT user_id, item_id, {rs('rating', 8)} AS rating FROM
  (SELECT user_id, item_id, rating FROM r UNION ALL SELECT user_id, item_id, rating FROM n)""")
def ratings_append(spark, sf):
    """A new user's ratings (5 for every part of size 1) join the table."""
    new = table(spark, sf, "part").filter("p_size = 1").select(
        F.lit(-1).cast("long").alias("user_id"), F.col("p_partkey").alias("item_id"), F.lit(5.0).alias("rating"))
    return RC.append_ratings(ratings(spark, sf).select("user_id", "item_id", "rating"), new).select(
        "user_id", "item_id", r("rating", 8).alias("rating"))


_DOT = " + ".join(f"({x}) * ({t})" for x, t in zip(_xs("item_id"), _ts("user_id")))


@query("cofi_cost", sql=f"""
WITH {_R},
fit AS (SELECT sum(power({_DOT} - rating, 2)) / 2.0 AS fit FROM r),
rx AS (SELECT sum({' + '.join(f'power({x}, 2)' for x in _xs('item_id'))}) AS rx
       FROM (SELECT DISTINCT item_id FROM r)),
rt AS (SELECT sum({' + '.join(f'power({t}, 2)' for t in _ts('user_id'))}) AS rt
       FROM (SELECT DISTINCT user_id FROM r))
SELECT {rs(f'fit + {LAM} / 2.0 * (rx + rt)', 6)} AS J FROM fit, rx, rt""")
def cofi_cost(spark, sf):
    """Regularised collaborative-filtering cost at the starting factors."""
    rt = ratings(spark, sf)
    X, T = init_factors(rt)
    return RC.cost(rt, X, T, K, LAM, user="user_id", item="item_id").select(r("J", 6).alias("J"))


def _grad_sql():
    e = f"e AS (SELECT item_id, user_id, {_DOT} - rating AS e FROM r)"
    gx = ("gx AS (SELECT item_id AS id, " + ", ".join(
        f"sum(e * ({t})) AS g{f}" for f, t in enumerate(_ts("user_id"))) + " FROM e GROUP BY item_id)")
    gt = ("gt AS (SELECT user_id AS id, " + ", ".join(
        f"sum(e * ({x})) AS g{f}" for f, x in enumerate(_xs("item_id"))) + " FROM e GROUP BY user_id)")
    sel = []
    for f in range(K):
        sel.append(f"SELECT 'X' AS kind, id, {f} AS f, {rs(f'g{f} + {LAM} * ({_xs('id')[f]})', 8)} AS grad FROM gx")
        sel.append(f"SELECT 'Theta', id, {f}, {rs(f'g{f} + {LAM} * ({_ts('id')[f]})', 8)} FROM gt")
    return f"WITH {_R}, {e}, {gx}, {gt}\n" + "\nUNION ALL\n".join(sel)


@query("cofi_gradient", sql=_grad_sql())
def cofi_gradient(spark, sf):
    """Gradients for item factors (X) and user factors (Theta)."""
    rt = ratings(spark, sf)
    X, T = init_factors(rt)
    g = RC.gradient(rt, X, T, K, LAM, user="user_id", item="item_id")
    return g.select("kind", "id", "f", r("grad", 8).alias("grad"))


@query("cofi_train")
def cofi_train(spark, sf):
    """Alternating least squares on the mean-normalised ratings (3
    factors, lam 1.5, 3 sweeps); returns the cost after every sweep."""
    rt, blocks = ratings_by_item(spark, sf)
    norm = RC.normalise(rt, item="item_id", user="user_id").drop("rating").withColumnRenamed("norm", "rating")
    X, T = init_factors(norm)
    _, _, hist = RC.train_als(norm, X, T, K, LAM, iters=3, user="user_id", item="item_id", blocks=blocks)
    return spark.createDataFrame(hist, "iter int, J double")


@query("cofi_blocked")
def cofi_blocked(spark, sf):
    """R5 over blocks with routing tables: the sweeps of ``cofi_train`` without
    moving a rating; returns the cost after every sweep."""
    rt, blocks = ratings_by_item(spark, sf)
    norm = RC.normalise(rt, item="item_id", user="user_id").drop("rating").withColumnRenamed("norm", "rating")
    _, _, hist = BA.train(norm, init_factors(norm)[1], K, LAM, iters=3, user="user_id", item="item_id", blocks=blocks)
    return spark.createDataFrame(hist, "iter int, J double")


@query("cofi_half_step", sql=f"""
WITH {_R}
SELECT item_id, {rs(f'sum(cos(user_id) * rating) / (sum(cos(user_id) * cos(user_id)) + {LAM})', 8)} AS x FROM r GROUP BY item_id""")
def cofi_half_step(spark, sf):
    """R5, one half-step with one factor: every item's factor for fixed user
    factors, against the closed form."""
    rt = ratings(spark, sf)
    side = BA.deal(rt, "item_id", "user_id", "rating", rt.count())
    T = rt.select("user_id").distinct().select(F.col("user_id").alias("id"), F.array(F.cos("user_id")).alias("f"))
    return BA.half_step(side, T, 1, LAM).select(F.col("id").alias("item_id"), r(F.col("f")[0], 8).alias("x"))


@query("recommend_topk", sql=f"""
WITH {_R},
u AS (SELECT user_id AS u FROM r GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1),
m AS (SELECT item_id, avg(rating) AS mu FROM r GROUP BY item_id),
p AS (SELECT item_id, {' + '.join(f'({x}) * ({t})' for x, t in zip(_xs('item_id'), _ts('u')))} + mu AS prediction
      FROM m, u),
t AS (SELECT * FROM p ORDER BY prediction DESC, item_id LIMIT 10)
SELECT CAST(row_number() OVER (ORDER BY prediction DESC, t.item_id) AS INTEGER) AS rank, t.item_id,
       {rs('prediction', 8)} AS prediction, p_name AS title
FROM t JOIN part ON p_partkey = t.item_id""")
def recommend_topk(spark, sf):
    """Top-10 items for the most active user (ties: lowest user id),
    prediction = factors . user factors + item mean, joined with titles."""
    rt = ratings(spark, sf)
    X, _ = init_factors(rt)
    top_user = (rt.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.col("n").desc(), "user_id").limit(1).first()["user_id"])
    theta = [math.cos(top_user * K + f + 1) / 10.0 for f in range(K)]
    means = RC.item_mean(rt, item="item_id").select("item_id", "mean_rating")
    top = RC.recommend_for_user(X, theta, means, 10, K, item="item_id")
    titles = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"),
                                             F.col("p_name").alias("title"))
    return top.join(titles, "item_id").select("rank", "item_id", r("prediction", 8).alias("prediction"),
                                              "title")


@query("recommend_trained")
def recommend_trained(spark, sf):
    """R5 then R6: factors trained on the mean-normalised ratings (3 sweeps)
    give the most active user's top-10 items."""
    rt, blocks = ratings_by_item(spark, sf)
    norm = RC.normalise(rt, item="item_id", user="user_id").drop("rating").withColumnRenamed("norm", "rating")
    counts = cut_lineage(rt.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))
    X0, T0 = init_factors(rt, counts)
    X, T, _ = RC.train_als(norm, X0, T0, K, LAM, iters=3, user="user_id", item="item_id", blocks=blocks)
    top_user = counts.orderBy(F.col("n").desc(), "user_id").first()
    if top_user is None:
        return spark.createDataFrame([], "rank int, item_id long, prediction double")
    t = T.filter(F.col("user_id") == top_user["user_id"]).first()
    means = RC.item_mean(rt, item="item_id").select("item_id", "mean_rating")
    top = RC.recommend_for_user(X, [t[f"t{f}"] for f in range(K)], means, 10, K, item="item_id")
    return top.select("rank", "item_id", r("prediction", 8).alias("prediction"))


# ---------------------------------------------------------------- SVM
W_LIN = [math.sin(j + 1) / 10.0 for j in range(EMB_DIMS)]
B_LIN = 0.05
SIGMA = 1.0
B_RBF = -0.1
LANDMARKS = 64

_EU = ("e AS (SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, "
       "CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)")
_LM = ("lm AS (SELECT label AS l, pos, avg(v) AS c FROM e GROUP BY label, pos),\n"
       "sim AS (SELECT e.vec_id, lm.l, exp(-sum((e.v - lm.c) * (e.v - lm.c)) / (2.0 * 1.0 * 1.0)) AS s "
       "FROM e JOIN lm ON lm.pos = e.pos GROUP BY e.vec_id, lm.l)")


@query("svm_predict", sql=f"""
WITH {_EU}, s AS (SELECT vec_id, sum(v * (sin(pos + 1) / 10.0)) + {B_LIN} AS score FROM e GROUP BY vec_id)
SELECT vec_id, {rs('score', 8)} AS score, CAST(score >= 0 AS INTEGER) AS pred FROM s""")
def svm_predict(spark, sf):
    """V3 (linear): score x.w + b and class score >= 0 for a given model."""
    x = emb(spark, sf)
    s = SV.linear_score("x", W_LIN, B_LIN)
    return x.select("vec_id", r(s, 8).alias("score"), SV.classify(s).alias("pred"))


def _landmarks(x):
    labels, L = SV.class_means(x, "x", "label", EMB_DIMS)
    return labels, L


@query("rbf_similarity", sql=f"""
WITH {_EU}, {_LM}
SELECT vec_id, l AS landmark, {rs('s', 8)} AS sim FROM sim""")
def rbf_similarity(spark, sf):
    """Gaussian similarity of every vector to every class-mean
    landmark (landmarks: a bounded model, inlined)."""
    x = emb(spark, sf)
    labels, L = _landmarks(x)
    lab = F.array(*[F.lit(v) for v in labels])
    feats = SV.similarity_features(x.select("vec_id", "x"), "x", L, SIGMA)
    out = feats.select("vec_id", F.posexplode("sims").alias("_i", "sim"))
    return out.select("vec_id", F.element_at(lab, F.col("_i") + 1).alias("landmark"),
                      r("sim", 8).alias("sim"))


@query("svm_rbf_predict", sql=f"""
WITH {_EU}, {_LM},
s AS (SELECT vec_id, sum(CASE WHEN l < 5 THEN 0.5 ELSE -0.5 END * s) + {B_RBF} AS score FROM sim GROUP BY vec_id)
SELECT vec_id, {rs('score', 8)} AS score, CAST(score >= 0 AS INTEGER) AS pred FROM s""")
def svm_rbf_predict(spark, sf):
    """V3 (kernel): sum alpha y K(x, s) + b over the landmark set."""
    x = emb(spark, sf)
    labels, L = _landmarks(x)
    coef = [0.5 if lab < 5 else -0.5 for lab in labels]
    feats = SV.similarity_features(x.select("vec_id", "x"), "x", L, SIGMA)
    s = array_dot("sims", coef, intercept=B_RBF)
    return feats.select("vec_id", r(s, 8).alias("score"), SV.classify(s).alias("pred"))


def _binary(spark, sf):
    return emb(spark, sf).withColumn("y", (F.col("label") < 5).cast("int"))


@query("svm_fit")
def svm_fit(spark, sf):
    """V1: soft-margin linear SVM (C = 1) on the 64-d vectors."""
    x = _binary(spark, sf)
    w, b = SV.fit_linear(x, "x", "y", C=1.0)
    rows = [(0, b)] + [(j + 1, float(v)) for j, v in enumerate(w)]
    return spark.createDataFrame(rows, "idx int, weight double")


@query("svm_rbf_fit")
def svm_rbf_fit(spark, sf):
    """V2: kernel SVM on the similarities to LANDMARKS sampled rows."""
    x = _binary(spark, sf)
    L = SV.row_landmarks(x, "x", "vec_id", LANDMARKS)
    w, b = SV.fit_rbf(x, "x", "y", L, SIGMA, C=1.0)
    rows = [(0, b)] + [(j + 1, float(v)) for j, v in enumerate(w)]
    return spark.createDataFrame(rows, "idx int, weight double")


@query("svm_grid")
def svm_grid(spark, sf):
    """V5: choose C and sigma by validation error (train/validation split
    by key)."""
    x = _binary(spark, sf)
    train, val = EV.split(x, "vec_id")
    L = SV.row_landmarks(train, "x", "vec_id", LANDMARKS)
    res = SV.grid_search(train, val, "x", "y", L, [0.1, 1.0, 10.0], [0.5, 1.0, 2.0])
    return spark.createDataFrame(res, "C double, sigma double, val_error double")
