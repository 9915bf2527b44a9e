"""Neural-network queries (N1-N8) on the embeddings (64 inputs, 5 hidden
units, one output per label), plus the numerical gradient check (N7) on
the logistic cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import features as FT
from keelson.operators import logistic as LG
from keelson.operators import network as NN
from keelson.plans.base import query, r, rs
from keelson.plans.data import LI_SQL, emb, li_design

HIDDEN = 5
LAM = 1.0

_E = ("e AS (SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) AS INTEGER) AS j, "
      "CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)")
# weights: W1 (5 x 65) and W2 (10 x 6), value sin(c * fan_out + r + 1) / 10
_W = ("w1 AS (SELECT CAST(o.range AS INTEGER) AS o, CAST(c.range AS INTEGER) AS c, "
      "sin(c.range * 5 + o.range + 1) / 10.0 AS w FROM range(5) o, range(65) c),\n"
      "w2 AS (SELECT CAST(o.range AS INTEGER) AS o, CAST(c.range AS INTEGER) AS c, "
      "sin(c.range * 10 + o.range + 1) / 10.0 AS w FROM range(10) o, range(6) c)")
_A2 = ("z2 AS (SELECT e.vec_id, w1.o AS u, sum(e.v * w1.w) + (SELECT w FROM w1 b WHERE b.o = w1.o AND b.c = 0) AS z "
       "FROM e JOIN w1 ON w1.c = e.j GROUP BY e.vec_id, w1.o),\n"
       "a2 AS (SELECT vec_id, u, 1.0 / (1.0 + exp(-z)) AS a FROM z2)")
_A3 = ("z3 AS (SELECT a2.vec_id, w2.o AS k, sum(a2.a * w2.w) + (SELECT w FROM w2 b WHERE b.o = w2.o AND b.c = 0) AS z "
       "FROM a2 JOIN w2 ON w2.c = a2.u + 1 GROUP BY a2.vec_id, w2.o),\n"
       "a3 AS (SELECT vec_id, k, z, 1.0 / (1.0 + exp(-z)) AS a FROM z3)")


def _setup(spark, sf):
    x = emb(spark, sf)
    dims = x.select(F.max(F.size("x"))).first()[0]
    classes = FT.distinct_classes(x, "label")
    W = [NN.init_fixed(HIDDEN, dims), NN.init_fixed(len(classes), HIDDEN)]
    return x, W, classes


@query("nn_init_fixed", sql="""
WITH """ + _W + f"""
SELECT 1 AS layer, o AS out, c AS "in", {rs('w', 10)} AS value FROM w1
UNION ALL SELECT 2, o, c, {rs('w', 10)} FROM w2""")
def nn_init_fixed(spark, sf):
    """Deterministic weights for a 64-5-K network (K = number of labels,
    64 = vector size, both read from the table)."""
    _, W, _ = _setup(spark, sf)
    return NN.weights_table(spark, W).select("layer", "out", "in", r("value", 10).alias("value"))


def _explode_act(df, name):
    return df.select("vec_id", F.posexplode("a").alias(name, "a")).select(
        "vec_id", F.col(name).cast("int").alias(name), r("a", 8).alias("a"))


@query("nn_layer", sql=f"WITH {_E}, {_W}, {_A2} SELECT vec_id, u AS unit, {rs('a', 8)} AS a FROM a2")
def nn_layer(spark, sf):
    """Hidden-layer activations sigmoid(W1 [1; x])."""
    x, W, _ = _setup(spark, sf)
    return _explode_act(NN.forward(x, "x", W, ["vec_id"], layer=1), "unit")


@query("nn_forward", sql=f"WITH {_E}, {_W}, {_A2}, {_A3} SELECT vec_id, k, {rs('a', 8)} AS a FROM a3")
def nn_forward(spark, sf):
    """Output activations of the 64-5-10 network."""
    x, W, _ = _setup(spark, sf)
    return _explode_act(NN.forward(x, "x", W, ["vec_id"]), "k")


@query("nn_predict", sql=f"""
WITH {_E}, {_W}, {_A2}, {_A3},
b AS (SELECT vec_id, k, a, row_number() OVER (PARTITION BY vec_id ORDER BY a DESC, k) AS rn FROM a3)
SELECT vec_id, CAST(k AS INTEGER) AS pred, {rs('a', 8)} AS prob FROM b WHERE rn = 1""")
def nn_predict(spark, sf):
    """Most active output (class) and its activation."""
    x, W, classes = _setup(spark, sf)
    p = NN.predict(x, "x", W, classes, ["vec_id"])
    return p.select("vec_id", F.col("pred").cast("int").alias("pred"), r("prob", 8).alias("prob"))


_LBL = "lbl AS (SELECT DISTINCT vec_id, label FROM e)"
_REG = f"(SELECT sum(w * w) FROM w1 WHERE c > 0) + (SELECT sum(w * w) FROM w2 WHERE c > 0)"


@query("nn_cost", sql=f"""
WITH {_E}, {_W}, {_A2}, {_A3}, {_LBL}
SELECT {rs(f'''sum(ln(1 + exp(-abs(z))) + greatest(z, 0.0) - CAST(k = label AS DOUBLE) * z)
  / count(DISTINCT a3.vec_id) + {LAM} / (2.0 * count(DISTINCT a3.vec_id)) * ({_REG})''', 10)} AS J
FROM a3 JOIN lbl ON lbl.vec_id = a3.vec_id""")
def nn_cost(spark, sf):
    """Regularised cost (lam = 1) of the network on all vectors."""
    x, W, classes = _setup(spark, sf)
    J, _, _ = NN.cost_and_gradient(x, "x", "label", W, classes, LAM)
    return spark.createDataFrame([(float(J),)], "J double").select(r("J", 10).alias("J"))


@query("nn_gradient", sql=f"""
WITH {_E}, {_W}, {_A2}, {_A3}, {_LBL},
m AS (SELECT count(*) * 1.0 AS m FROM lbl),
d3 AS (SELECT a3.vec_id, a3.k, a3.a - CAST(a3.k = lbl.label AS DOUBLE) AS d FROM a3 JOIN lbl ON lbl.vec_id = a3.vec_id),
g2 AS (SELECT d3.k AS o, 0 AS c, sum(d3.d) AS g FROM d3 GROUP BY d3.k
       UNION ALL SELECT d3.k, a2.u + 1, sum(d3.d * a2.a) FROM d3 JOIN a2 ON a2.vec_id = d3.vec_id GROUP BY d3.k, a2.u),
d2 AS (SELECT a2.vec_id, a2.u, sum(d3.d * w2.w) * a2.a * (1 - a2.a) AS d
       FROM a2 JOIN d3 ON d3.vec_id = a2.vec_id JOIN w2 ON w2.o = d3.k AND w2.c = a2.u + 1
       GROUP BY a2.vec_id, a2.u, a2.a),
g1 AS (SELECT d2.u AS o, 0 AS c, sum(d2.d) AS g FROM d2 GROUP BY d2.u
       UNION ALL SELECT d2.u, e.j, sum(d2.d * e.v) FROM d2 JOIN e ON e.vec_id = d2.vec_id GROUP BY d2.u, e.j)
SELECT 1 AS layer, CAST(g1.o AS INTEGER) AS out, CAST(g1.c AS INTEGER) AS "in",
       {rs(f'g1.g / m + CASE WHEN g1.c > 0 THEN {LAM} / m * w1.w ELSE 0.0 END', 10)} AS grad
FROM g1 JOIN w1 ON w1.o = g1.o AND w1.c = g1.c, m
UNION ALL
SELECT 2, CAST(g2.o AS INTEGER), CAST(g2.c AS INTEGER),
       {rs(f'g2.g / m + CASE WHEN g2.c > 0 THEN {LAM} / m * w2.w ELSE 0.0 END', 10)}
FROM g2 JOIN w2 ON w2.o = g2.o AND w2.c = g2.c, m""")
def nn_gradient(spark, sf):
    """Back-propagation gradient (one distributed pass: per-partition
    partial sums keyed by parameter)."""
    x, W, classes = _setup(spark, sf)
    _, grads, _ = NN.cost_and_gradient(x, "x", "label", W, classes, LAM)
    return NN.weights_table(spark, grads, "grad").select("layer", "out", "in",
                                                          r("grad", 10).alias("grad"))


@query("nn_train")
def nn_train(spark, sf):
    """L-BFGS training (lam = 1, 10 iterations) of the 64-5-K network
    from the fixed start; returns the cost per iteration."""
    x, W, classes = _setup(spark, sf)
    data = x.select("x", "label").persist()
    try:
        res = NN.train(data, "x", "label", W, classes, lam=LAM, max_iter=10)
    finally:
        data.unpersist()
    return spark.createDataFrame(res.history, "iter int, J double")


@query("nn_fit_predict")
def nn_fit_predict(spark, sf):
    """Train on all vectors, then every vector's class and probability."""
    x, W, classes = _setup(spark, sf)
    data = x.select("x", "label").persist()
    try:
        res = NN.train(data, "x", "label", W, classes, lam=LAM, max_iter=10)
    finally:
        data.unpersist()
    return NN.predict(x, "x", res.weights, classes, ["vec_id", "label"])


def _curve_parts(spark, sf):
    from keelson.operators import evaluate as EV
    x, W, classes = _setup(spark, sf)
    train, val = EV.split(x, "vec_id")
    return train.persist(), val, W, classes


@query("nn_learning_curve")
def nn_learning_curve(spark, sf):
    """E9 for networks: training and validation cost of networks trained on the
    first 10, 20, 50, 100, .. vectors (lam = 1, 10 iterations), all in the same
    passes."""
    from keelson.operators import evaluate as EV
    train, val, W, classes = _curve_parts(spark, sf)
    try:
        curve = NN.learning_curve(train, val, "x", "label", W, classes, ["vec_id"], EV.doubling_sizes(), LAM, 10)
    finally:
        train.unpersist()
    return spark.createDataFrame([(int(m), float(a), float(b)) for m, a, b in curve], "size long, J_train double, J_val double")


PENALTIES = [0.0, 0.01, 0.1, 0.3, 1.0, 3.0, 10.0]


@query("nn_lambda_curve")
def nn_lambda_curve(spark, sf):
    """E10 for networks: unpenalised training and validation cost of networks
    trained with seven penalties (10 iterations), all in the same passes."""
    train, val, W, classes = _curve_parts(spark, sf)
    try:
        curve = NN.lambda_curve(train, val, "x", "label", W, classes, PENALTIES, 10)
    finally:
        train.unpersist()
    return spark.createDataFrame(curve, "lambda double, J_train double, J_val double")


# ---------------------------------------------------------------- N7
THETA = [-1.0, 0.3, -0.5]
EPS = 1e-4


def _num_sql():
    def loss(t):
        z = f"({t[0]!r} + {t[1]!r} * x1 + {t[2]!r} * x2)"
        return f"ln(1 + exp(-abs({z}))) + greatest({z}, 0.0) - yr * {z}"
    parts = []
    for j in range(3):
        tp = list(THETA)
        tm = list(THETA)
        tp[j] += EPS
        tm[j] -= EPS
        regp = tp[1] ** 2 + tp[2] ** 2
        regm = tm[1] ** 2 + tm[2] ** 2
        jp = f"(sum({loss(tp)}) + {LAM} * {regp!r} / 2.0) / count(*)"
        jm = f"(sum({loss(tm)}) + {LAM} * {regm!r} / 2.0) / count(*)"
        xj = ["1.0", "x1", "x2"][j]
        an = (f"(sum((1.0 / (1.0 + exp(-({THETA[0]!r} + {THETA[1]!r} * x1 + {THETA[2]!r} * x2))) - yr) * {xj})"
              f" + {0.0 if j == 0 else LAM * THETA[j]!r}) / count(*)")
        parts.append(f"SELECT {j} AS idx, {rs(f'({jp} - {jm}) / {2 * EPS!r}', 7)} AS numeric, "
                     f"{rs(an, 7)} AS analytic FROM ({LI_SQL})")
    return "\nUNION ALL\n".join(parts)


@query("numeric_gradient", sql=_num_sql())
def numeric_gradient(spark, sf):
    """Central-difference gradient of the logistic cost beside the
    analytic one; all 2P perturbed costs in ONE aggregate."""
    d = li_design(spark, sf)
    out = LG.numeric_gradient_frame(d, ["x1", "x2"], "yr", THETA, LAM, EPS)
    return out.select("idx", r("numeric", 7).alias("numeric"), r("analytic", 7).alias("analytic"))
