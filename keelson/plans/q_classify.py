"""Logistic regression, one-vs-all and classification metrics (C1-C9,
E1-E3) on the lineitem design: binary target yr = (returnflag = 'R'),
three-class target flag."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import evaluate as EV
from keelson.operators import features as FT
from keelson.operators import logistic as LG
from keelson.plans.base import query, r, rs
from keelson.plans.data import LI_SQL, emb, li_design

THETA = [-1.0, 0.3, -0.5]
LAM = 1.0
POLY_THETA = [-1.5, 0.4, -0.3, 0.05, 0.02, -0.1]  # 1, x1, x2, x1^2, x1x2, x2^2
OVA = {"A": [0.5, -0.2, 0.1], "N": [0.3, 0.1, -0.2], "R": [-0.4, 0.05, 0.3]}

_Z = "(-1.0 + 0.3 * x1 + -0.5 * x2)"
_LOSS = "(ln(1 + exp(-abs({z}))) + greatest({z}, 0.0) - yr * {z})"
_PZ = "(-1.5 + 0.4 * x1 + -0.3 * x2 + 0.05 * (x1 * x1) + 0.02 * (x1 * x2) + -0.1 * (x2 * x2))"
_PP = f"(1.0 / (1.0 + exp(-{_PZ})))"


def _ova_p(c):
    t = OVA[c]
    return f"(1.0 / (1.0 + exp(-({t[0]!r} + {t[1]!r} * x1 + {t[2]!r} * x2))))"


_OVA_PRED = (f"CASE WHEN {_ova_p('A')} >= {_ova_p('N')} AND {_ova_p('A')} >= {_ova_p('R')} THEN 'A' "
             f"WHEN {_ova_p('N')} >= {_ova_p('R')} THEN 'N' ELSE 'R' END")
_OVA_CONF = f"greatest({_ova_p('A')}, {_ova_p('N')}, {_ova_p('R')}) * 100.0"


@query("log_predict", sql=f"""
SELECT l_orderkey, l_linenumber, {rs(f'1.0 / (1.0 + exp(-{_Z}))', 8)} AS p FROM ({LI_SQL})""")
def log_predict(spark, sf):
    """sigmoid(X theta) for every row."""
    d = li_design(spark, sf)
    return d.select("l_orderkey", "l_linenumber", r(LG.hypothesis(["x1", "x2"], THETA), 8).alias("p"))


@query("log_cost", sql=f"""
SELECT {rs(f"(sum({_LOSS.format(z=_Z)}) + {LAM} * (0.09 + 0.25) / 2.0) / count(*)", 10)} AS J
FROM ({LI_SQL})""")
def log_cost(spark, sf):
    """Regularised cross-entropy at a given theta (lam = 1)."""
    d = li_design(spark, sf)
    return d.agg(r(LG.cost_expr(["x1", "x2"], "yr", THETA, LAM), 10).alias("J"))


@query("log_gradient", sql=f"""
WITH d AS (SELECT 1.0 / (1.0 + exp(-{_Z})) - yr AS e, x1, x2 FROM ({LI_SQL}))
SELECT 0 AS idx, {rs('sum(e) / count(*)', 10)} AS grad FROM d
UNION ALL SELECT 1, {rs(f'(sum(e * x1) + {LAM} * 0.3) / count(*)', 10)} FROM d
UNION ALL SELECT 2, {rs(f'(sum(e * x2) + {LAM} * -0.5) / count(*)', 10)} FROM d""")
def log_gradient(spark, sf):
    """Gradient at a given theta."""
    d = li_design(spark, sf)
    return LG.gradient_frame(d, ["x1", "x2"], "yr", THETA, LAM) \
        .select("idx", r("grad", 10).alias("grad"))


@query("relabel", sql=f"""
SELECT l_orderkey, l_linenumber, CASE flag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE flag END AS label
FROM ({LI_SQL})""")
def relabel(spark, sf):
    """Class names of the return flags; other values pass through."""
    d = li_design(spark, sf)
    return d.select("l_orderkey", "l_linenumber",
                    FT.relabel("flag", {"R": "returned", "A": "accepted"}).alias("label"))


@query("log_fit")
def log_fit(spark, sf):
    """C4: regularised logistic fit (degree-2 map, lam = 1) by Newton
    iterations, one aggregate each; returns theta and the final cost."""
    d = li_design(spark, sf)
    mapped = FT.polymap(d, ["x1", "x2"], 2, keep=["yr"], bias=False, prefix="m")
    names = [c for c in mapped.columns if c.startswith("m")]
    model = LG.fit(mapped, names, "yr", lam=1.0)
    rows = [(j, float(t), model.cost) for j, t in enumerate(model.theta)]
    return spark.createDataFrame(rows, "idx int, theta double, J double")


def _pair(x):
    return x.withColumn("y5", (F.col("label") < 5).cast("int"))


@query("log_fit_wide")
def log_fit_wide(spark, sf):
    """C4 on array features: label < 5 against the 64-d embeddings (lam = 1);
    theta, final cost and whether the gradient vanished."""
    model = LG.fit(_pair(emb(spark, sf)), "x", "y5", lam=1.0)
    rows = [(j, float(t), model.cost, model.converged) for j, t in enumerate(model.theta)]
    return spark.createDataFrame(rows, "idx int, theta double, J double, converged boolean")


@query("ova_fit_wide")
def ova_fit_wide(spark, sf):
    """C6 on array features: all labels against the 64-d embeddings (lam = 1)."""
    model = LG.fit_one_vs_all(emb(spark, sf), "x", "label", lam=1.0)
    rows = [(int(c), j, float(t), model.converged[c]) for c in model.classes for j, t in enumerate(model.thetas[c])]
    return spark.createDataFrame(rows, "class int, idx int, theta double, converged boolean")


def _gd_sql(steps, alpha):
    ctes = [f"d AS ({LI_SQL})", "s0 AS (SELECT 0.0::DOUBLE AS t0, 0.0::DOUBLE AS t1, 0.0::DOUBLE AS t2)"]
    sel = []
    for t in range(steps + 1):
        z = f"(s{t}.t0 + s{t}.t1 * x1 + s{t}.t2 * x2)"
        ctes.append(f"a{t} AS (SELECT count(*) * 1.0 AS m, sum({_LOSS.format(z=z)}) AS J, "
                    f"sum(1.0 / (1.0 + exp(-{z})) - yr) AS g0, "
                    f"sum((1.0 / (1.0 + exp(-{z})) - yr) * x1) AS g1, "
                    f"sum((1.0 / (1.0 + exp(-{z})) - yr) * x2) AS g2 FROM d, s{t})")
        if t < steps:
            ctes.append(f"s{t + 1} AS (SELECT t0 - {alpha} * g0 / m AS t0, t1 - {alpha} * g1 / m AS t1, "
                        f"t2 - {alpha} * g2 / m AS t2 FROM s{t}, a{t})")
        sel.append(f"SELECT {t} AS iter, {rs('J / m', 10)} AS J, {rs('t0', 10)} AS theta0, "
                   f"{rs('t1', 10)} AS theta1, {rs('t2', 10)} AS theta2 FROM s{t}, a{t}")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(sel)


@query("log_gd_steps", sql=_gd_sql(3, 1.0))
def log_gd_steps(spark, sf):
    """C4 (fixed steps): three gradient steps (alpha 1) from theta = 0."""
    d = li_design(spark, sf)
    path = LG.gd_steps(d, ["x1", "x2"], "yr", 1.0, 3)
    rows = [(it, float(J), *map(float, th)) for it, J, th in path]
    df = spark.createDataFrame(rows, "iter int, J double, theta0 double, theta1 double, theta2 double")
    return df.select("iter", *[r(c, 10).alias(c) for c in ["J", "theta0", "theta1", "theta2"]])


@query("log_classify", sql=f"""
SELECT l_orderkey, l_linenumber, {rs(_PP, 8)} AS p, CAST({_PP} > 0.5 AS INTEGER) AS pred
FROM ({LI_SQL})""")
def log_classify(spark, sf):
    """Degree-2 map, probability and class (p > 0.5)."""
    d = li_design(spark, sf)
    m = FT.polymap(d, ["x1", "x2"], 2, keep=["l_orderkey", "l_linenumber"], bias=False, prefix="m")
    p, c = LG.predict([f"m{i}" for i in range(5)], POLY_THETA)
    return m.select("l_orderkey", "l_linenumber", r(p, 8).alias("p"), c.alias("pred"))


@query("ova_fit")
def ova_fit(spark, sf):
    """One-vs-all logistic fit over the three return flags (all
    classes' Newton systems in one aggregate per iteration)."""
    d = li_design(spark, sf)
    model = LG.fit_one_vs_all(d, ["x1", "x2"], "flag", lam=1.0)
    rows = [(c, j, float(t)) for c in model.classes for j, t in enumerate(model.thetas[c])]
    return spark.createDataFrame(rows, "class string, idx int, theta double")


def _ova_model():
    import numpy as np
    return LG.OneVsAll(list(OVA), {c: np.array(t) for c, t in OVA.items()})


@query("ova_predict", sql=f"""
SELECT l_orderkey, l_linenumber, {_OVA_PRED} AS pred, {rs(_OVA_CONF, 8)} AS confidence
FROM ({LI_SQL})""")
def ova_predict(spark, sf):
    """Argmax class and 100 * max probability over the class models."""
    d = li_design(spark, sf)
    cls, conf = LG.predict_one_vs_all(_ova_model(), ["x1", "x2"])
    return d.select("l_orderkey", "l_linenumber", cls.alias("pred"), r(conf, 8).alias("confidence"))


_GN = 25


@query("decision_grid", sql=f"""
WITH rg AS (SELECT min(x1) AS lo1, max(x1) AS hi1, min(x2) AS lo2, max(x2) AS hi2 FROM ({LI_SQL})),
g AS (SELECT CAST(i.range AS INTEGER) AS i, CAST(j.range AS INTEGER) AS j,
        lo1 + i.range * ((hi1 - lo1) / {_GN - 1}.0) AS x1, lo2 + j.range * ((hi2 - lo2) / {_GN - 1}.0) AS x2
      FROM rg, range({_GN}) i, range({_GN}) j)
SELECT i, j, {rs('x1')} AS x1, {rs('x2')} AS x2, {rs(_PP, 8)} AS p,
       CAST({_PP} > 0.5 AS INTEGER) AS pred FROM g""")
def decision_grid(spark, sf):
    """Score a grid spanning the data range (the decision surface)."""
    d = li_design(spark, sf)
    (lo1, hi1), (lo2, hi2) = FT.data_range(d, ["x1", "x2"])
    g = FT.grid_2d(spark, (lo1, hi1), (lo2, hi2), _GN)
    m = FT.polymap(g, ["x1", "x2"], 2, keep=["i", "j", "x1", "x2"], bias=False, prefix="m")
    p, c = LG.predict([f"m{i}" for i in range(5)], POLY_THETA)
    return m.select("i", "j", r("x1").alias("x1"), r("x2").alias("x2"), r(p, 8).alias("p"),
                    c.alias("pred"))


# ---------------------------------------------------------------- metrics
@query("accuracy", sql=f"""
SELECT {rs(f'avg(CAST(CAST({_PP} > 0.5 AS INTEGER) = yr AS DOUBLE)) * 100.0', 8)} AS accuracy_pct
FROM ({LI_SQL})""")
def accuracy(spark, sf):
    """Accuracy of a degree-2 logistic classifier with given coefficients
    (``fit_accuracy`` scores fitted ones)."""
    d = li_design(spark, sf)
    m = FT.polymap(d, ["x1", "x2"], 2, keep=["yr"], bias=False, prefix="m")
    _, c = LG.predict([f"m{i}" for i in range(5)], POLY_THETA)
    return EV.accuracy(m.withColumn("pred", c), "pred", "yr") \
        .select(r("accuracy_pct", 8).alias("accuracy_pct"))


def _ova_scored(spark, sf):
    d = li_design(spark, sf)
    cls, _ = LG.predict_one_vs_all(_ova_model(), ["x1", "x2"])
    return d.withColumn("pred", cls)


@query("confusion", sql=f"""
SELECT flag AS truth, {_OVA_PRED} AS pred, count(*) AS n FROM ({LI_SQL}) GROUP BY 1, 2""")
def confusion(spark, sf):
    """Counts by truth x prediction for the one-vs-all classifier."""
    return EV.confusion(_ova_scored(spark, sf), "flag", "pred")


@query("class_report", sql=f"""
WITH c AS (SELECT flag AS truth, {_OVA_PRED} AS pred FROM ({LI_SQL})),
t AS (SELECT truth AS class, count(*) AS support, sum(CAST(truth = pred AS BIGINT)) AS tp
      FROM c GROUP BY truth),
p AS (SELECT pred AS class, count(*) AS predicted FROM c GROUP BY pred),
j AS (SELECT coalesce(t.class, p.class) AS class, coalesce(support, 0) AS support,
             coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted
      FROM t FULL OUTER JOIN p ON t.class = p.class),
m AS (SELECT class, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support FROM j),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                ELSE 0.0 END AS f1 FROM m)
SELECT class, {rs('precision', 8)} AS precision, {rs('recall', 8)} AS recall,
       CAST(support AS BIGINT) AS support, {rs('f1', 8)} AS f1 FROM f
UNION ALL
SELECT 'weighted avg', {rs('sum(precision * support) / sum(support)', 8)},
       {rs('sum(recall * support) / sum(support)', 8)}, CAST(sum(support) AS BIGINT),
       {rs('sum(f1 * support) / sum(support)', 8)} FROM f""")
def class_report(spark, sf):
    """Precision / recall / F1 / support per class + weighted average."""
    rep = EV.class_report(_ova_scored(spark, sf), "flag", "pred")
    return rep.select("class", r("precision", 8).alias("precision"), r("recall", 8).alias("recall"),
                      "support", r("f1", 8).alias("f1"))


@query("split", sql="""
SELECT CASE WHEN ((event_id * 48271 + 17) % 2147483647) % 5 = 0 THEN 'val' ELSE 'train' END AS split,
       count(*) AS n, """ + rs("avg(value)", 8) + """ AS mean_value
FROM events GROUP BY 1""")
def split_q(spark, sf):
    """E5: deterministic 80/20 train/validation split by key (sizes and
    mean value per part)."""
    from keelson.plans.base import table
    ev = table(spark, sf, "events")
    lab = EV.split_label("event_id")
    return ev.groupBy(lab.alias("split")).agg(F.count(F.lit(1)).alias("n"),
                                              r(F.avg("value"), 8).alias("mean_value"))


# ---------------------------------------------------------------- fitted, then scored
NEWTON = 5


def _newton_ova_sql(steps: int = NEWTON, lam: float = 1.0) -> str:
    """Newton steps of one-feature models, one for each flag, written out with
    2 x 2 systems; p is every line's probability by class."""
    out = [f"d AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM ({LI_SQL}))", "s0 AS (SELECT DISTINCT flag AS class, 0.0::DOUBLE AS t0, 0.0::DOUBLE AS t1 FROM d WHERE flag IS NOT NULL)"]
    for t in range(steps):
        p = f"(1.0 / (1.0 + exp(-(s{t}.t0 + s{t}.t1 * x1))))"
        e = f"({p} - CAST(d.flag = s{t}.class AS DOUBLE))"
        out.append(f"""g{t} AS MATERIALIZED (SELECT s{t}.class, any_value(t0) AS t0, any_value(t1) AS t1, sum({e}) AS g0,
    sum({e} * x1) + {lam} * any_value(t1) AS g1, sum({p} * (1 - {p})) AS h00, sum({p} * (1 - {p}) * x1) AS h01,
    sum({p} * (1 - {p}) * x1 * x1) + {lam} AS h11 FROM d CROSS JOIN s{t} GROUP BY s{t}.class),
s{t + 1} AS MATERIALIZED (SELECT class, t0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS t0,
    t1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS t1 FROM g{t})""")
    out.append(f"""scored AS (SELECT d.flag AS truth, s.class AS pred FROM d CROSS JOIN s{steps} s
  QUALIFY row_number() OVER (PARTITION BY d.rid ORDER BY s.t0 + s.t1 * d.x1 DESC, s.class) = 1)""")
    return "WITH " + ",\n".join(out)


def _fitted_flags(spark, sf):
    """Every line with the class of one-vs-all models fitted on all lines."""
    d = li_design(spark, sf)
    cls, _ = LG.predict_one_vs_all(LG.fit_one_vs_all(d, ["x1"], "flag", lam=1.0), ["x1"])
    return d.withColumn("pred", cls)


@query("fit_theta", sql=_newton_ova_sql() + f"""
SELECT class, 0 AS idx, {rs('t0')} AS theta FROM s{NEWTON} UNION ALL SELECT class, 1, {rs('t1')} FROM s{NEWTON}""")
def fit_theta(spark, sf):
    """One-vs-all fit of the flags on one feature (against Newton steps in
    SQL)."""
    model = LG.fit_one_vs_all(li_design(spark, sf), ["x1"], "flag", lam=1.0)
    rows = [(c, j, float(t)) for c in model.classes for j, t in enumerate(model.thetas[c])]
    return spark.createDataFrame(rows, "class string, idx int, theta double").select("class", "idx", r("theta").alias("theta"))


@query("fit_confusion", sql=_newton_ova_sql() + """
SELECT truth, pred, count(*) AS n FROM scored GROUP BY truth, pred""")
def fit_confusion(spark, sf):
    """Fit one-vs-all on all lines, score all lines, count by truth
    and prediction."""
    return EV.confusion(_fitted_flags(spark, sf), "flag", "pred")


@query("fit_accuracy", sql=_newton_ova_sql() + f"""
SELECT {rs('avg(CAST(truth = pred AS DOUBLE)) * 100.0', 8)} AS accuracy_pct FROM scored""")
def fit_accuracy(spark, sf):
    """Training accuracy of the fitted one-vs-all model."""
    return EV.accuracy(_fitted_flags(spark, sf), "flag", "pred").select(r("accuracy_pct", 8).alias("accuracy_pct"))


@query("fit_report")
def fit_report(spark, sf):
    """Per-class report of a degree-2 one-vs-all model fitted on all lines
    and scored on them."""
    d = li_design(spark, sf)
    m = FT.polymap(d, ["x1", "x2"], 2, keep=["flag"], bias=False, prefix="m")
    names = [f"m{i}" for i in range(5)]
    cls, _ = LG.predict_one_vs_all(LG.fit_one_vs_all(m, names, "flag", lam=1.0), names)
    return EV.class_report(m.withColumn("pred", cls), "flag", "pred")


@query("fit_decision_grid")
def fit_decision_grid(spark, sf):
    """The surface of a degree-2 logistic model fitted on all lines."""
    d = li_design(spark, sf)
    names = [f"m{i}" for i in range(5)]
    theta = LG.fit(FT.polymap(d, ["x1", "x2"], 2, keep=["yr"], bias=False, prefix="m"), names, "yr", 1.0).theta
    (lo1, hi1), (lo2, hi2) = FT.data_range(d, ["x1", "x2"])
    g = FT.grid_2d(spark, (lo1, hi1), (lo2, hi2), _GN)
    m = FT.polymap(g, ["x1", "x2"], 2, keep=["i", "j", "x1", "x2"], bias=False, prefix="m")
    p, c = LG.predict(names, theta)
    return m.select("i", "j", "x1", "x2", p.alias("p"), c.alias("pred"))
