"""Gaussian anomaly detection queries (A1-A5, P3) on events: features
value and the JSON field k, truth = event_type 'error'."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import anomaly as AN
from keelson.plans.base import query, r, rs
from keelson.plans.data import EV_SQL, ev_design

FEATS = ["value", "k"]
EPS = 5e-5

_PAR = ("par AS (SELECT avg(value) AS mu_v, var_pop(value) AS var_v, avg(k) AS mu_k, "
        f"var_pop(k) AS var_k FROM ({EV_SQL}))")
_LOGP = ("(-0.5 * ln(2 * pi() * var_v) - (value - mu_v) * (value - mu_v) / (2.0 * var_v)"
         " + -0.5 * ln(2 * pi() * var_k) - (k - mu_k) * (k - mu_k) / (2.0 * var_k))")
_DENS = f"dens AS (SELECT event_id, is_error, {_LOGP} AS log_p, exp({_LOGP}) AS p FROM ({EV_SQL}), par)"


def _density(spark, sf):
    ev = ev_design(spark, sf)
    mu, var = AN.estimate_params(ev, FEATS)
    lp = AN.log_density(FEATS, mu, var)
    return ev.withColumn("log_p", lp).withColumn("p", F.exp(lp))


@query("gauss_params", sql=f"""
SELECT 'value' AS feature, {rs('avg(value)', 8)} AS mu, {rs('var_pop(value)', 6)} AS var FROM ({EV_SQL})
UNION ALL
SELECT 'k', {rs('avg(k)', 8)}, {rs('var_pop(k)', 6)} FROM ({EV_SQL})""")
def gauss_params(spark, sf):
    """A1: mean and population variance per feature."""
    mu, var = AN.estimate_params(ev_design(spark, sf), FEATS)
    rows = [(f, m, v) for f, m, v in zip(FEATS, mu, var)]
    return spark.createDataFrame(rows, "feature string, mu double, var double") \
        .select("feature", r("mu", 8).alias("mu"), r("var", 6).alias("var"))


@query("gauss_density", sql=f"""
WITH {_PAR}, {_DENS}
SELECT event_id, {rs('log_p', 8)} AS log_p, {rs('p', 15)} AS p FROM dens""")
def gauss_density(spark, sf):
    """A2: product of per-feature normal densities (log scale, then exp)."""
    d = _density(spark, sf)
    return d.select("event_id", r("log_p", 8).alias("log_p"), r("p", 15).alias("p"))


@query("mv_gauss_density", sql=f"""
WITH c AS (SELECT avg(value) AS m1, avg(k) AS m2, covar_pop(value, value) AS a,
                  covar_pop(value, k) AS b, covar_pop(k, k) AS cc FROM ({EV_SQL})),
q AS (SELECT event_id, (cc * (value - m1) * (value - m1) - 2 * b * (value - m1) * (k - m2)
             + a * (k - m2) * (k - m2)) / (a * cc - b * b) AS q, ln(a * cc - b * b) AS ld
      FROM ({EV_SQL}), c)
SELECT event_id, {rs('-0.5 * (2 * ln(2 * pi()) + ld) - 0.5 * q', 8)} AS log_p,
       {rs('exp(-0.5 * (2 * ln(2 * pi()) + ld) - 0.5 * q)', 15)} AS p FROM q""")
def mv_gauss_density(spark, sf):
    """A3: bivariate normal density with the full covariance matrix."""
    ev = ev_design(spark, sf)
    mu, S = AN.estimate_covariance(ev, FEATS)
    lp = AN.mv_log_density(FEATS, mu, S)
    return ev.select("event_id", r(lp, 8).alias("log_p"), r(F.exp(lp), 15).alias("p"))


@query("f1_at_threshold", sql=f"""
WITH {_PAR}, {_DENS},
c AS (SELECT CAST(sum(CAST(p < {EPS!r} AND is_error = 1 AS BIGINT)) AS BIGINT) AS tp,
             CAST(sum(CAST(p < {EPS!r} AND is_error <> 1 AS BIGINT)) AS BIGINT) AS fp,
             CAST(sum(CAST(p >= {EPS!r} AND is_error = 1 AS BIGINT)) AS BIGINT) AS fn FROM dens),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM c)
SELECT {rs(repr(EPS), 12)} AS epsilon, tp, fp, fn, {rs('precision', 8)} AS precision,
       {rs('recall', 8)} AS recall,
       {rs('CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END', 8)} AS f1
FROM m""")
def f1_at_threshold(spark, sf):
    """A4: precision / recall / F1 of 'density below epsilon' vs truth."""
    d = _density(spark, sf)
    out = AN.f1_at(d, "p", "is_error", EPS)
    return out.select(r("epsilon", 12).alias("epsilon"), "tp", "fp", "fn",
                      *[r(c, 8).alias(c) for c in ["precision", "recall", "f1"]])


_BEST = f"""{_PAR}, {_DENS},
rg AS (SELECT min(p) AS lo, max(p) AS hi, (max(p) - min(p)) / 1000 AS step,
              sum(is_error) AS npos FROM dens),
g AS (SELECT range AS i, lo + range * step AS eps FROM range(1000), rg),
c AS (SELECT g.i, g.eps, sum(CAST(d.p < g.eps AND d.is_error = 1 AS BIGINT)) AS tp,
             sum(CAST(d.p < g.eps AND d.is_error <> 1 AS BIGINT)) AS fp
      FROM g, dens d GROUP BY g.i, g.eps),
m AS (SELECT c.*, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS pr,
             CASE WHEN npos > 0 THEN tp / npos ELSE 0.0 END AS rc FROM c, rg),
f AS (SELECT i, eps, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1 FROM m),
best AS (SELECT eps, f1 FROM f ORDER BY f1 DESC, i LIMIT 1)"""


@query("best_threshold", sql=f"""
WITH {_BEST}
SELECT {rs('eps', 15)} AS epsilon, {rs('f1', 8)} AS f1 FROM best""")
def best_threshold(spark, sf):
    """A5: best epsilon on a 1000-point grid by F1 (first maximum), in one
    pass over the densities."""
    d = _density(spark, sf)
    eps, f1 = AN.best_threshold(d, "p", "is_error")
    return spark.createDataFrame([(eps, f1)], "epsilon double, f1 double") \
        .select(r("epsilon", 15).alias("epsilon"), r("f1", 8).alias("f1"))


@query("outliers", sql=f"""
WITH {_BEST}
SELECT event_id, event_type, {rs('p', 15)} AS p
FROM dens JOIN ({EV_SQL}) e USING (event_id), best WHERE p < best.eps""")
def outliers(spark, sf):
    """The events whose density falls below the selected epsilon."""
    d = _density(spark, sf)
    eps, _ = AN.best_threshold(d, "p", "is_error")
    return AN.outliers(d, "p", eps).select("event_id", "event_type", r("p", 15).alias("p"))
