"""Evaluation and model-selection queries.

k-fold ridge and the lambda grid use one grouped Gram scan (training Gram
of fold f = total - G_f).  Fold-averaged class probabilities come from
per-fold class-frequency models on events (class given the hour)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import evaluate as EV
from keelson.operators import logistic as LG
from keelson.operators.indexing import top_k_per_group
from keelson.plans.base import query, r, rs, table
from keelson.plans.data import EV_SQL, LI_SQL, ev_design, li_design
from keelson.sources import writers

KF = 5
RIDGE_LAM = 10.0
LAMBDAS = [0.0, 1.0, 10.0, 100.0, 1000.0, 10000.0]
CLASSES = ["click", "error", "purchase", "signup", "view"]

_FOLD = "CAST((({key} * 48271 + 17) % 2147483647) % {k} AS INTEGER)"

_FS = f"""d AS (SELECT {_FOLD.format(key='l_orderkey', k=KF)} AS fold, x1, y FROM ({LI_SQL})),
fs AS (SELECT fold, count(*) * 1.0 AS n, sum(x1) AS sx, sum(y) AS sy, sum(x1 * x1) AS sxx,
              sum(x1 * y) AS sxy, sum(y * y) AS syy FROM d GROUP BY fold),
tot AS (SELECT sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM fs),
tr AS (SELECT fs.fold, tot.n - fs.n AS n, tot.sx - fs.sx AS sx, tot.sy - fs.sy AS sy,
              tot.sxx - fs.sxx AS sxx, tot.sxy - fs.sxy AS sxy FROM fs, tot)"""


def _th(lam: str) -> str:
    return (f"SELECT fold, {lam} AS lam, (sxy - sx * sy / n) / (sxx - sx * sx / n + {lam}) AS t1, sx, sy, n "
            f"FROM tr")


_MSE = ("(fs.syy - 2 * t0 * fs.sy - 2 * t1 * fs.sxy + fs.n * t0 * t0 + 2 * t0 * t1 * fs.sx "
        "+ t1 * t1 * fs.sxx) / fs.n")


@query("kfold_oof", sql=f"""
WITH {_FS},
th AS (SELECT fold, t1, (sy - t1 * sx) / n AS t0 FROM ({_th(repr(RIDGE_LAM))}))
SELECT fs.fold, CAST(fs.n AS BIGINT) AS n, {rs('t0')} AS theta0, {rs('t1')} AS theta1, {rs(_MSE)} AS mse
FROM fs JOIN th ON th.fold = fs.fold""")
def kfold_oof(spark, sf):
    """5-fold out-of-fold ridge (folds by order key): each fold scored
    by the model of the other folds, all from one grouped Gram scan."""
    d = li_design(spark, sf)
    folds = EV.kfold_ridge(d, ["x1"], "y", EV.fold_of("l_orderkey", KF), KF, RIDGE_LAM)
    rows = [(f["fold"], f["n"], float(f["theta"][0]), float(f["theta"][1]), float(f["mse"]))
            for f in folds]
    df = spark.createDataFrame(rows, "fold int, n long, theta0 double, theta1 double, mse double")
    return df.select("fold", "n", *[r(c).alias(c) for c in ["theta0", "theta1", "mse"]])


@query("lambda_grid", sql=f"""
WITH {_FS},
lams AS (SELECT * FROM (VALUES {', '.join(f'({lam!r})' for lam in LAMBDAS)}) t(lam)),
th AS (SELECT tr.fold, lams.lam, (sxy - sx * sy / n) / (sxx - sx * sx / n + lams.lam) AS t1, sx, sy, n
       FROM tr, lams),
th2 AS (SELECT fold, lam, t1, (sy - t1 * sx) / n AS t0 FROM th)
SELECT CAST(lam AS DOUBLE) AS lambda, {rs(f'sum(({_MSE}) * fs.n) / sum(fs.n)')} AS cv_mse
FROM th2 JOIN fs ON fs.fold = th2.fold GROUP BY lam""")
def lambda_grid(spark, sf):
    """E8 (ridge): cross-validated error for every lambda, one scan."""
    d = li_design(spark, sf)
    res = EV.lambda_grid(d, ["x1"], "y", EV.fold_of("l_orderkey", KF), KF, LAMBDAS)
    return spark.createDataFrame(res, "lambda double, cv_mse double") \
        .select("lambda", r("cv_mse").alias("cv_mse"))


@query("kfold_rows", sql=f"""
WITH d AS (SELECT l_orderkey, l_linenumber, x1, y, {_FOLD.format(key='l_orderkey', k=KF)} AS fold FROM ({LI_SQL})),
s AS (SELECT fold, count(*) * 1.0 AS n, sum(x1) AS sx, sum(y) AS sy, sum(x1 * x1) AS sxx, sum(x1 * y) AS sxy FROM d GROUP BY fold),
t AS (SELECT a.fold, sum(b.n) AS n, sum(b.sx) AS sx, sum(b.sy) AS sy, sum(b.sxx) AS sxx, sum(b.sxy) AS sxy
      FROM s a JOIN s b ON b.fold <> a.fold GROUP BY a.fold),
th AS (SELECT fold, (sxy - sx * sy / n) / (sxx - sx * sx / n) AS t1, sx, sy, n FROM t)
SELECT l_orderkey, l_linenumber, CAST(d.fold AS INTEGER) AS fold, {rs('d.y')} AS y,
       {rs('(th.sy - th.t1 * th.sx) / th.n + th.t1 * d.x1')} AS pred FROM d JOIN th ON th.fold = d.fold""")
def kfold_rows(spark, sf):
    """E6 (rows): the out-of-fold prediction of every line item."""
    d = li_design(spark, sf)
    out = EV.kfold_predict(d, ["x1"], "y", EV.fold_of("l_orderkey", KF), KF, keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "fold", r("y").alias("y"), r("pred").alias("pred"))


@query("grid_search")
def grid_search(spark, sf):
    """Polynomial degree x lambda grid, 5-fold cross-validated, from one
    grouped Gram of the highest degree."""
    d = li_design(spark, sf)
    res = EV.poly_grid_search(d, "x1", "y", EV.fold_of("l_orderkey", KF), KF,
                              [1, 2, 3], [0.0, 10.0, 1000.0])
    return spark.createDataFrame(res, "degree int, lambda double, cv_mse double")


# ---------------------------------------------------------------- curves on events
SIZES = EV.doubling_sizes(10)
VAL_LAMBDAS = [0.0, 1.0, 10.0, 100.0, 1000.0, 10000.0, 100000.0]
_SPLIT = (f"CASE WHEN {_FOLD.format(key='event_id', k=5)} = 0 THEN 'val' ELSE 'train' END")
_EVS = f"ev AS (SELECT event_id, k, value, {_SPLIT} AS split FROM ({EV_SQL}))"


def _sums(src: str, extra: str = "") -> str:
    return (f"SELECT {extra} count(*) * 1.0 AS n, sum(k) AS sx, sum(value) AS sy, sum(k * k) AS sxx, "
            f"sum(k * value) AS sxy, sum(value * value) AS syy FROM {src}")


def _jc(p: str) -> str:
    """Cost J of (t0, t1) from the sums of table ``p``."""
    return (f"({p}.syy - 2 * t0 * {p}.sy - 2 * t1 * {p}.sxy + {p}.n * t0 * t0 + 2 * t0 * t1 * {p}.sx "
            f"+ t1 * t1 * {p}.sxx) / (2 * {p}.n)")


def _ev_split(spark, sf):
    ev = ev_design(spark, sf)
    return EV.split(ev, "event_id")


@query("learning_curve", sql=f"""
WITH {_EVS},
t AS (SELECT k, value, row_number() OVER (ORDER BY event_id) AS rn FROM ev WHERE split = 'train'),
sz AS (SELECT DISTINCT least(size, (SELECT count(*) FROM t)) AS size
       FROM (VALUES {', '.join(f'({s})' for s in SIZES)}) s(size)),
g AS (SELECT size, count(*) * 1.0 AS n, sum(k) AS sx, sum(value) AS sy, sum(k * k) AS sxx,
             sum(k * value) AS sxy, sum(value * value) AS syy
      FROM sz JOIN t ON t.rn <= sz.size GROUP BY size HAVING count(*) = size),
th AS (SELECT size, (sxy - sx * sy / n) / (sxx - sx * sx / n) AS t1, sx, sy, n FROM g),
th2 AS (SELECT size, t1, (sy - t1 * sx) / n AS t0 FROM th),
v AS ({_sums("ev WHERE split = 'val'")})
SELECT CAST(g.size AS BIGINT) AS size,
       {rs(_jc('g'))} AS train_error, {rs(_jc('v'))} AS val_error
FROM g JOIN th2 ON th2.size = g.size, v""")
def learning_curve(spark, sf):
    """Fit y ~ k on the first i training events (by id) for growing i, up to all;
    training and validation error per size, from one bucketed Gram scan."""
    train, val = _ev_split(spark, sf)
    res = EV.learning_curve(train, val, ["k"], "value", ["event_id"], SIZES)
    return spark.createDataFrame([(int(s), float(a), float(b)) for s, a, b in res],
                                 "size long, train_error double, val_error double") \
        .select("size", r("train_error").alias("train_error"), r("val_error").alias("val_error"))


@query("validation_curve", sql=f"""
WITH {_EVS},
g AS ({_sums("ev WHERE split = 'train'")}),
v AS ({_sums("ev WHERE split = 'val'")}),
lams AS (SELECT * FROM (VALUES {', '.join(f'({lam!r})' for lam in VAL_LAMBDAS)}) t(lam)),
th AS (SELECT lam, (sxy - sx * sy / n) / (sxx - sx * sx / n + lam) AS t1, sx, sy, n FROM g, lams),
th2 AS (SELECT lam, t1, (sy - t1 * sx) / n AS t0 FROM th)
SELECT CAST(lam AS DOUBLE) AS lambda,
       {rs(_jc('g'))} AS train_error, {rs(_jc('v'))} AS val_error
FROM th2, g, v""")
def validation_curve(spark, sf):
    """Training / validation error of ridge y ~ k for each lambda."""
    train, val = _ev_split(spark, sf)
    res = EV.validation_curve(train, val, ["k"], "value", VAL_LAMBDAS)
    return spark.createDataFrame(res, "lambda double, train_error double, val_error double") \
        .select("lambda", r("train_error").alias("train_error"), r("val_error").alias("val_error"))


# ---------------------------------------------------------------- fold-averaged probabilities
_PROBS = f"""ev AS (SELECT event_id, event_type AS cls, hour(ts) AS h,
                {_FOLD.format(key='event_id', k=KF)} AS fold FROM events),
cnt AS (SELECT fold, h, cls, count(*) AS n FROM ev GROUP BY fold, h, cls),
folds AS (SELECT DISTINCT fold FROM ev), hrs AS (SELECT DISTINCT h FROM ev), cl AS (SELECT DISTINCT cls FROM ev),
nhc AS (SELECT h, cls, sum(n) AS n FROM cnt GROUP BY h, cls),
nh AS (SELECT h, sum(n) AS n FROM cnt GROUP BY h),
nfh AS (SELECT fold, h, sum(n) AS n FROM cnt GROUP BY fold, h),
g AS (SELECT folds.fold, hrs.h, cl.cls FROM folds, hrs, cl),
pf AS (SELECT g.fold, g.h, g.cls, (coalesce(nhc.n, 0) - coalesce(cnt.n, 0) + 1.0)
              / (nh.n - coalesce(nfh.n, 0) + (SELECT count(*) FROM cl)) AS p
       FROM g LEFT JOIN cnt ON cnt.fold = g.fold AND cnt.h = g.h AND cnt.cls = g.cls
       LEFT JOIN nhc ON nhc.h = g.h AND nhc.cls = g.cls JOIN nh ON nh.h = g.h
       LEFT JOIN nfh ON nfh.fold = g.fold AND nfh.h = g.h),
fm AS (SELECT h, cls, avg(p) AS p FROM pf GROUP BY h, cls),
pr AS (SELECT ev.event_id, ev.cls AS truth, fm.cls AS class, fm.p FROM ev JOIN fm ON fm.h = ev.h)"""


def _probs(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", F.hour("ts").alias("h"))
    fold = EV.fold_of("event_id", KF)
    fm = EV.kfold_frequency_models(ev, "h", "event_type", fold, KF)
    return EV.fold_frequency_predict(ev, "event_id", "h", fm, keep=["event_type"])


@query("fold_mean", sql=f"WITH {_PROBS} SELECT event_id, class, {rs('p', 8)} AS p FROM pr")
def fold_mean(spark, sf):
    """Element-wise mean over the 5 fold models' class probabilities
    (each model: Laplace-smoothed class frequency given the hour, trained
    without its fold), attached to every event."""
    probs = _probs(spark, sf)
    return probs.select("event_id", "class", r("p", 8).alias("p"))


@query("submission_pivot", sql=f"""
WITH {_PROBS}
SELECT event_id, {', '.join(f"{rs(f'max(CASE WHEN class = {chr(39)}{c}{chr(39)} THEN p END)', 8)} AS {c}" for c in CLASSES)}
FROM pr GROUP BY event_id""")
def submission_pivot(spark, sf):
    """The prediction table (one column per class) as written to CSV."""
    probs = _probs(spark, sf)
    wide = writers.submission_frame(probs, "event_id", "class", "p", CLASSES)
    return wide.select("event_id", *[r(c, 8).alias(c) for c in CLASSES])


@query("log_loss", sql=f"""
WITH {_PROBS},
c AS (SELECT event_id, truth, class, least(greatest(p, 1e-15), 1 - 1e-15) AS p FROM pr),
z AS (SELECT event_id, sum(p) AS z, sum(CASE WHEN class = truth THEN p END) AS pt FROM c GROUP BY event_id)
SELECT {rs('avg(-ln(pt / z))', 10)} AS log_loss FROM z""")
def log_loss(spark, sf):
    """Multi-class log loss of the fold-averaged probabilities."""
    j = _probs(spark, sf).withColumnRenamed("event_type", "truth")
    return EV.log_loss(j, "event_id", "class", "p", "truth").select(r("log_loss", 10).alias("log_loss"))


@query("limit_per_group", sql="""
SELECT lang, doc_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rank FROM documents)
WHERE rank <= 50""")
def limit_per_group(spark, sf):
    """S6 (cap per category): the first 50 documents of every language."""
    d = table(spark, sf, "documents").select("lang", "doc_id")
    return top_k_per_group(d, ["lang"], [F.col("doc_id")], 50).select("lang", "doc_id", "rank")


# ---------------------------------------------------------------- E6, iterative models
NEWTON = 4


def _newton_fold_sql(steps: int = NEWTON, lam: float = 1.0) -> str:
    """Newton steps of one-feature logistic models, one for each fold left out,
    written out with 2 x 2 systems; s is (t0, t1) by fold."""
    out = [f"""d AS MATERIALIZED (SELECT {_FOLD.format(key='l_orderkey', k=KF)} AS f, l_orderkey, l_linenumber, x1, yr FROM ({LI_SQL})),
k AS (SELECT CAST(range AS INTEGER) AS fold FROM range({KF})),
s0 AS (SELECT fold, 0.0::DOUBLE AS t0, 0.0::DOUBLE AS t1 FROM k)"""]
    for t in range(steps):
        p = f"(1.0 / (1.0 + exp(-(s{t}.t0 + s{t}.t1 * x1))))"
        out.append(f"""g{t} AS MATERIALIZED (SELECT s{t}.fold, any_value(t0) AS t0, any_value(t1) AS t1, sum({p} - yr) AS g0,
    sum(({p} - yr) * x1) + {lam} * any_value(t1) AS g1, sum({p} * (1 - {p})) AS h00, sum({p} * (1 - {p}) * x1) AS h01,
    sum({p} * (1 - {p}) * x1 * x1) + {lam} AS h11 FROM d JOIN s{t} ON s{t}.fold <> d.f GROUP BY s{t}.fold),
s{t + 1} AS MATERIALIZED (SELECT fold, t0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS t0,
    t1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS t1 FROM g{t})""")
    return "WITH " + ",\n".join(out)


_OOF_P = f"(1.0 / (1.0 + exp(-(s{NEWTON}.t0 + s{NEWTON}.t1 * d.x1))))"


def _fold_models(spark, sf, **kw):
    d = li_design(spark, sf).withColumn("cls", F.col("yr").cast("int"))
    return LG.fit_folds(d, ["x1"], "cls", EV.fold_of("l_orderkey", KF), KF, lam=1.0, classes=[0, 1], **kw)


@query("kfold_logistic", sql=_newton_fold_sql() + f"""
SELECT d.f AS fold, count(*) AS n, {rs(f'avg(-ln(CASE WHEN d.yr = 1 THEN {_OOF_P} ELSE 1.0 - {_OOF_P} END))', 8)} AS log_loss,
       {rs(f'any_value(s{NEWTON}.t0)')} AS theta0, {rs(f'any_value(s{NEWTON}.t1)')} AS theta1
FROM d JOIN s{NEWTON} ON s{NEWTON}.fold = d.f GROUP BY d.f""")
def kfold_logistic(spark, sf):
    """E6 for an iterative model: five logistic fits without one fold each, all
    advanced together by Newton passes; the log loss of each fold by the model
    that hasn't seen it."""
    models, _ = _fold_models(spark, sf)
    rows = [(f, models.rows[f], float(models.loss[f]), *map(float, models.thetas[f][1])) for f in sorted(models.rows)]
    df = spark.createDataFrame(rows, "fold int, n long, log_loss double, theta0 double, theta1 double")
    return df.select("fold", "n", r("log_loss", 8).alias("log_loss"), r("theta0").alias("theta0"), r("theta1").alias("theta1"))


@query("kfold_logistic_oof", sql=_newton_fold_sql() + f"""
SELECT d.l_orderkey, d.l_linenumber, d.f AS fold, CAST(d.yr AS INTEGER) AS truth, {rs(_OOF_P, 7)} AS p
FROM d JOIN s{NEWTON} ON s{NEWTON}.fold = d.f""")
def kfold_logistic_oof(spark, sf):
    """E6, rows: every line's probability from the model of the other folds."""
    _, oof = _fold_models(spark, sf, keep=["l_orderkey", "l_linenumber"])
    return oof.select("l_orderkey", "l_linenumber", "fold", F.col("_y").alias("truth"), r(F.element_at("p", 2), 7).alias("p"))
