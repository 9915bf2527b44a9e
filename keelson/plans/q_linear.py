"""Linear-regression queries (L1-L12, E11, E12) on the lineitem design:
x1 = quantity/10, x2 = discount*10, x3 = tax*10, y = extendedprice/1000.

Spark side: one Gram scan per fit, then (n+2)^2 numbers on the driver.
SQL side: the same closed forms (centred normal equations by Cramer's
rule, recursive CTE for gradient descent)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import features as FT
from keelson.operators import gram as G
from keelson.operators import linear as LR
from keelson.operators import qr as QR
from keelson.plans.base import query, r, rs
from keelson.plans.data import LI_SQL, li_design


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def cramer_cte(src: str, a: str = "x1", b: str = "x2", y: str = "y", lam: float = 0.0) -> str:
    """CTEs st, th, theta: two-feature least squares (ridge when lam > 0,
    intercept unpenalised) from centred moments."""
    L = dbl(lam)
    return f"""st AS (SELECT avg({a}) AS a1, avg({b}) AS a2, avg({y}) AS ay,
    var_pop({a}) * count(*) + {L} AS c11, covar_pop({a}, {b}) * count(*) AS c12,
    var_pop({b}) * count(*) + {L} AS c22, covar_pop({a}, {y}) * count(*) AS c1y,
    covar_pop({b}, {y}) * count(*) AS c2y FROM {src}),
th AS (SELECT (c1y * c22 - c2y * c12) / (c11 * c22 - c12 * c12) AS t1,
    (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS t2, a1, a2, ay FROM st),
theta AS (SELECT ay - t1 * a1 - t2 * a2 AS t0, t1, t2 FROM th)"""


THETA = [1.0, 0.5, -2.0]
LAM = 1.0


@query("lin_cost", sql=f"""
SELECT {rs(f'(sum(power(1.0 + 0.5 * x1 + -2.0 * x2 - y, 2)) + {LAM} * (0.25 + 4.0)) / (2.0 * count(*))')} AS J
FROM ({LI_SQL})""")
def lin_cost(spark, sf):
    """L2: regularised squared-error cost at a given theta (lam = 1)."""
    d = li_design(spark, sf)
    return LR.cost_frame(d, ["x1", "x2"], "y", THETA, LAM).select(r("J").alias("J"))


@query("lin_gradient", sql=f"""
WITH d AS (SELECT 1.0 + 0.5 * x1 + -2.0 * x2 - y AS e, x1, x2 FROM ({LI_SQL}))
SELECT 0 AS idx, {rs('sum(e) / count(*)')} AS grad FROM d
UNION ALL SELECT 1, {rs(f'(sum(e * x1) + {LAM} * 0.5) / count(*)')} FROM d
UNION ALL SELECT 2, {rs(f'(sum(e * x2) + {LAM} * -2.0) / count(*)')} FROM d""")
def lin_gradient(spark, sf):
    """L3: gradient at a given theta, all components in one aggregate."""
    d = li_design(spark, sf)
    g = LR.gradient_frame(d, ["x1", "x2"], "y", THETA, LAM)
    return g.select("idx", r("grad").alias("grad"))


_GT = ["1.0", "x1", "x2", "x3", "y"]


@query("gram", sql="\nUNION ALL\n".join(
    f"SELECT {i} AS i, {j} AS j, {rs(f'avg({_GT[i]} * {_GT[j]})', 8)} AS value FROM ({LI_SQL})"
    for i in range(5) for j in range(i, 5)))
def gram_q(spark, sf):
    """L4: augmented Gram matrix / m (upper triangle), one scan."""
    d = li_design(spark, sf)
    Gm = G.gram(d, ["x1", "x2", "x3"], "y")
    m = Gm[0, 0]
    rows = [(i, j, float(Gm[i, j] / m)) for i in range(5) for j in range(i, 5)]
    return spark.createDataFrame(rows, "i int, j int, value double") \
        .select("i", "j", r("value", 8).alias("value"))


def _theta_rows(spark, theta):
    return spark.createDataFrame([(j, float(t)) for j, t in enumerate(theta)],
                                 "idx int, theta double").select("idx", r("theta").alias("theta"))


_THETA_SQL = """SELECT 0 AS idx, {t0} AS theta FROM theta UNION ALL SELECT 1, {t1} FROM theta
UNION ALL SELECT 2, {t2} FROM theta""".format(t0=rs("t0"), t1=rs("t1"), t2=rs("t2"))


@query("lin_normal", sql=f"WITH {cramer_cte(f'({LI_SQL})')}\n{_THETA_SQL}")
def lin_normal(spark, sf):
    """Least squares by the normal equation (pinv of X'X)."""
    d = li_design(spark, sf)
    return _theta_rows(spark, LR.fit_normal(d, ["x1", "x2"], "y"))


RIDGE_LAM = 1000.0


@query("ridge", sql=f"WITH {cramer_cte(f'({LI_SQL})', lam=RIDGE_LAM)}\n{_THETA_SQL}")
def ridge(spark, sf):
    """Ridge fit (intercept unpenalised) from the same Gram scan."""
    d = li_design(spark, sf)
    return _theta_rows(spark, LR.fit_normal(d, ["x1", "x2"], "y", lam=RIDGE_LAM))


def _z_design(spark, sf):
    d = li_design(spark, sf)
    m = FT.fit_normalizer(d, ["x1", "x2"])
    return FT.normalize(d, m)


_Z_SQL = (f"SELECT l_orderkey, l_linenumber, (x1 - mu1) / sd1 AS x1, (x2 - mu2) / sd2 AS x2, y "
          f"FROM ({LI_SQL}), (SELECT avg(x1) AS mu1, stddev_pop(x1) AS sd1, avg(x2) AS mu2, "
          f"stddev_pop(x2) AS sd2 FROM ({LI_SQL}))")
_ZG = f"""zg AS (SELECT count(*) * 1.0 AS m, sum(x1) AS s1, sum(x2) AS s2, sum(y) AS sy,
  sum(x1 * x1) AS s11, sum(x1 * x2) AS s12, sum(x2 * x2) AS s22, sum(x1 * y) AS s1y,
  sum(x2 * y) AS s2y, sum(y * y) AS syy FROM ({_Z_SQL}))"""
_J = ("(t0 * t0 * m + t1 * t1 * s11 + t2 * t2 * s22 + 2 * t0 * t1 * s1 + 2 * t0 * t2 * s2 "
      "+ 2 * t1 * t2 * s12 - 2 * (t0 * sy + t1 * s1y + t2 * s2y) + syy) / (2 * m)")


def _gd_step(alpha: str) -> str:
    return (f"t0 - {alpha} * (m * t0 + s1 * t1 + s2 * t2 - sy) / m, "
            f"t1 - {alpha} * (s1 * t0 + s11 * t1 + s12 * t2 - s1y) / m, "
            f"t2 - {alpha} * (s2 * t0 + s12 * t1 + s22 * t2 - s2y) / m")


GD_ITERS = 30


@query("gd_history", sql=f"""
WITH RECURSIVE {_ZG},
it(iter, t0, t1, t2) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL SELECT iter + 1, {_gd_step('0.1')} FROM it, zg WHERE iter < {GD_ITERS})
SELECT iter, {rs(_J)} AS J, {rs('t0')} AS theta0, {rs('t1')} AS theta1, {rs('t2')} AS theta2
FROM it, zg""")
def gd_history(spark, sf):
    """Batch gradient descent path (alpha 0.1, 30 steps) on normalised
    features: one Gram scan, iterations on the driver."""
    Gm = G.gram(_z_design(spark, sf), ["x1", "x2"], "y")
    path = LR.gradient_descent(Gm, 0.1, GD_ITERS)
    rows = [(it, float(J), *map(float, th)) for it, J, th in path]
    df = spark.createDataFrame(rows, "iter int, J double, theta0 double, theta1 double, theta2 double")
    return df.select("iter", *[r(c).alias(c) for c in ["J", "theta0", "theta1", "theta2"]])


ALPHAS = [0.001, 0.003, 0.01, 0.03, 0.1, 0.3, 1.0]


@query("gd_alpha_sweep", sql=f"""
WITH RECURSIVE {_ZG},
al(alpha) AS (VALUES {', '.join(f'({dbl(a)})' for a in ALPHAS)}),
it(alpha, iter, t0, t1, t2) AS (
  SELECT alpha, 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM al
  UNION ALL SELECT alpha, iter + 1, {_gd_step('alpha')} FROM it, zg WHERE iter < {GD_ITERS})
SELECT alpha, {rs(_J)} AS J FROM it, zg WHERE iter = {GD_ITERS}""")
def gd_alpha_sweep(spark, sf):
    """Final cost after 30 steps for several learning rates (one scan)."""
    Gm = G.gram(_z_design(spark, sf), ["x1", "x2"], "y")
    rows = [(a, float(LR.gradient_descent(Gm, a, GD_ITERS)[-1][1])) for a in ALPHAS]
    return spark.createDataFrame(rows, "alpha double, J double").select("alpha", r("J").alias("J"))


@query("lin_accuracy", sql=f"""
WITH {cramer_cte(f'({LI_SQL})')}
SELECT {rs('avg(power(t0 + t1 * x1 + t2 * x2 - y, 2))')} AS mse,
       {rs('avg(1.0 - abs(t0 + t1 * x1 + t2 * x2 - y) / y) * 100.0')} AS accuracy_pct
FROM ({LI_SQL}), theta""")
def lin_accuracy(spark, sf):
    """Training mean squared error and mean relative accuracy."""
    d = li_design(spark, sf)
    th = LR.fit_normal(d, ["x1", "x2"], "y")
    return LR.accuracy_frame(d, ["x1", "x2"], "y", th).select(
        r("mse").alias("mse"), r("accuracy_pct").alias("accuracy_pct"))


CS_N = 20
CS_T0 = (-10.0, 10.0)
CS_T1 = (-1.0, 4.0)


@query("cost_surface", sql=f"""
WITH g AS (SELECT count(*) * 1.0 AS m, sum(x1) AS sx, sum(y) AS sy, sum(x1 * x1) AS sxx,
                  sum(x1 * y) AS sxy, sum(y * y) AS syy FROM ({LI_SQL})),
p AS (SELECT CAST(i.range AS INTEGER) AS i, CAST(j.range AS INTEGER) AS j,
             {dbl(CS_T0[0])} + i.range * {dbl((CS_T0[1] - CS_T0[0]) / (CS_N - 1))} AS a,
             {dbl(CS_T1[0])} + j.range * {dbl((CS_T1[1] - CS_T1[0]) / (CS_N - 1))} AS b
      FROM range({CS_N}) i, range({CS_N}) j)
SELECT i, j, {rs('a')} AS theta0, {rs('b')} AS theta1,
  {rs('(syy - 2.0 * a * sy - 2.0 * b * sxy + m * a * a + 2.0 * a * b * sx + b * b * sxx) / (2.0 * m)')} AS cost
FROM p, g""")
def cost_surface(spark, sf):
    """J over a (theta0, theta1) grid for y ~ x1, from five Gram sums."""
    Gm = G.gram(li_design(spark, sf), ["x1"], "y")
    s = LR.cost_surface(spark, Gm, CS_T0, CS_T1, CS_N)
    return s.select("i", "j", r("theta0").alias("theta0"), r("theta1").alias("theta1"),
                    r("cost").alias("cost"))


FC_N = 40


@query("fit_curve", sql=f"""
WITH s AS (SELECT avg(x1) AS mu1, stddev_pop(x1) AS sd1, avg(x1 * x1) AS mu2,
                  stddev_pop(x1 * x1) AS sd2, min(x1) AS lo, max(x1) AS hi FROM ({LI_SQL})),
z AS (SELECT (x1 - mu1) / sd1 AS z1, (x1 * x1 - mu2) / sd2 AS z2, y FROM ({LI_SQL}), s),
{cramer_cte('z', 'z1', 'z2')},
pts AS (SELECT CAST(range AS INTEGER) AS i, lo + range * ((hi - lo) / {FC_N - 1}.0) AS x
        FROM range({FC_N}), s)
SELECT i, {rs('x')} AS x, {rs('t0 + t1 * (x - mu1) / sd1 + t2 * (x * x - mu2) / sd2')} AS y_hat
FROM pts, s, theta""")
def fit_curve(spark, sf):
    """Degree-2 polynomial fit on normalised powers, evaluated on 40
    points spanning the data range."""
    d = li_design(spark, sf)
    p = FT.poly_features(d, "x1", 2, keep=["y"], prefix="p")
    nm = FT.fit_normalizer(p, ["p1", "p2"])
    th = G.solve(G.gram(FT.normalize(p, nm), ["p1", "p2"], "y"))
    (lo, hi), = FT.data_range(d, ["x1"])
    step = (hi - lo) / (FC_N - 1)
    pts = spark.range(FC_N).select(F.col("id").cast("int").alias("i"),
                                   (F.lit(lo) + F.col("id").cast("double") * F.lit(step)).alias("p1"))
    pts = pts.withColumn("p2", F.col("p1") * F.col("p1")).withColumn("x", F.col("p1"))
    scored = FT.normalize(pts, nm).withColumn("y_hat", LR.hypothesis(["p1", "p2"], th))
    return scored.select("i", r("x").alias("x"), r("y_hat").alias("y_hat"))


@query("lin_predict", sql=f"""
WITH {cramer_cte(f'({_Z_SQL})')}
SELECT l_orderkey, l_linenumber, {rs('t0 + t1 * x1 + t2 * x2')} AS y_hat
FROM ({_Z_SQL}), theta""")
def lin_predict(spark, sf):
    """Normalise the rows with the fitted normaliser, then score
    with the normal-equation theta."""
    z = _z_design(spark, sf)
    th = LR.fit_normal(z, ["x1", "x2"], "y")
    return z.select("l_orderkey", "l_linenumber",
                    r(LR.hypothesis(["x1", "x2"], th)).alias("y_hat"))


@query("r2", sql=f"""
WITH {cramer_cte(f'({LI_SQL})')}
SELECT {rs('1.0 - sum(power(y - (t0 + t1 * x1 + t2 * x2), 2)) / (var_pop(y) * count(*))', 8)} AS r2
FROM ({LI_SQL}), theta""")
def r2(spark, sf):
    """Coefficient of determination of the least-squares fit."""
    d = li_design(spark, sf)
    th = LR.fit_normal(d, ["x1", "x2"], "y")
    return LR.r2_frame(d, LR.hypothesis(["x1", "x2"], th), "y").select(r("r2", 8).alias("r2"))


# ---------------------------------------------------------------- QR
@query("qr_ridge", sql=f"WITH {cramer_cte(f'({LI_SQL})', lam=RIDGE_LAM)}\n{_THETA_SQL}")
def qr_ridge(spark, sf):
    """L5/L6 without moments: ridge coefficients from a tree of triangular
    factors."""
    return _theta_rows(spark, QR.factor(li_design(spark, sf), ["x1", "x2"], "y").coefficients(RIDGE_LAM))


FAR = 1e9


@query("qr_far_feature", sql=f"""
WITH d AS (SELECT l_quantity + {FAR} AS x, y FROM (SELECT l_quantity, l_extendedprice / 1000.0 AS y FROM lineitem))
SELECT {rs('regr_slope(y, x)', 5)} AS slope, {rs('avg(y)')} AS at_mean, {rs('sqrt(regr_r2(y, x))', 5)} AS r FROM d""")
def qr_far_feature(spark, sf):
    """L5 on a feature whose mean is 1e8 times its spread, where raw moments
    have no digit left: slope, fitted value at the mean, correlation."""
    from keelson.plans.base import table
    d = table(spark, sf, "lineitem").select((F.col("l_quantity") + FAR).alias("x"), (F.col("l_extendedprice") / 1000.0).alias("y"))
    f = QR.factor(d, ["x"], "y")
    theta = f.coefficients()
    flat = f.cost([f.y_shift, 0.0])
    r2 = 1.0 - f.cost(theta) / flat if flat else 0.0
    return spark.createDataFrame([(float(theta[1]), float(theta[0] + theta[1] * f.shift[0]), float(max(r2, 0.0) ** 0.5))],
                                 "slope double, at_mean double, r double").select(
        r("slope", 5).alias("slope"), r("at_mean").alias("at_mean"), r("r", 5).alias("r"))
