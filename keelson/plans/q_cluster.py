"""k-means (K2-K6) on the 64-d embeddings and PCA (D1-D7): the 64-d
second-moment matrix of the normalised embeddings, and the 2-d analysis of
the normalised lineitem pair (x1, y)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.operators import features as FT
from keelson.operators import kmeans as KM
from keelson.operators import pca as PC
from keelson.plans.base import query, r, rs, table
from keelson.plans.data import EMB_DIMS, LI_SQL, emb, li_design

K = 8
QK = 16

_E = ("e AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, "
      "CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)")


def _init_sql(k):
    return (f"ci AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS k, vec_id AS cid "
            f"FROM (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT {k})),\n"
            f"c0 AS (SELECT ci.k, e.pos, e.v FROM ci JOIN e ON e.vec_id = ci.cid)")


def _assign_sql(name, cents):
    return (f"{name}d AS (SELECT e.vec_id, c.k, sum((e.v - c.v) * (e.v - c.v)) AS d2 FROM e "
            f"JOIN {cents} c ON c.pos = e.pos GROUP BY e.vec_id, c.k),\n"
            f"{name} AS (SELECT vec_id, k, d2 FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY vec_id ORDER BY d2, k) AS rn FROM {name}d) WHERE rn = 1)")


def _update_sql(t):
    return (f"c{t} AS (SELECT o.k, o.pos, coalesce(nw.v, o.v) AS v FROM c{t - 1} o LEFT JOIN "
            f"(SELECT a.k, e.pos, avg(e.v) AS v FROM a{t} a JOIN e ON e.vec_id = a.vec_id "
            f"GROUP BY a.k, e.pos) nw ON nw.k = o.k AND nw.pos = o.pos)")


def _km_sql(k, iters):
    parts = [_E, _init_sql(k)]
    for t in range(1, iters + 1):
        parts.append(_assign_sql(f"a{t}", f"c{t - 1}"))
        parts.append(_update_sql(t))
    return "WITH " + ",\n".join(parts)


def _init(spark, sf, k):
    x = emb(spark, sf)
    return x, KM.init_first_by_key(x, "x", "vec_id", k)


@query("kmeans_assign", sql=f"""
WITH {_E}, {_init_sql(K)}, {_assign_sql('a', 'c0')}
SELECT vec_id, k, {rs('d2', 8)} AS d2 FROM a""")
def kmeans_assign(spark, sf):
    """K2: nearest of 8 centroids (initialised with the first 8 rows by key)."""
    x, c0 = _init(spark, sf, K)
    return KM.assign(x, "x", c0).select("vec_id", "k", r("d2", 8).alias("d2"))


@query("kmeans_update", sql=f"""
{_km_sql(K, 1)}
SELECT k, pos, {rs('v', 8)} AS value FROM c1""")
def kmeans_update(spark, sf):
    """K3: one centroid update (member means; empty clusters keep theirs)."""
    x, c0 = _init(spark, sf, K)
    c1 = KM.update(KM.assign(x, "x", c0), "x", EMB_DIMS, c0)
    return KM.centroid_table(spark, c1).select("k", "pos", r("value", 8).alias("value"))


@query("kmeans_cohesion", sql=f"""
WITH {_E}, {_init_sql(K)}, {_assign_sql('a', 'c0')},
c AS (SELECT k, count(*) AS n, avg(d2) AS cohesion FROM a GROUP BY k)
SELECT k, n, {rs('cohesion', 8)} AS cohesion FROM c
UNION ALL SELECT -1, CAST(sum(n) AS BIGINT), {rs('avg(cohesion)', 8)} FROM c""")
def kmeans_cohesion(spark, sf):
    """K4: mean squared distance per cluster, and overall (k = -1: the
    unweighted mean over clusters)."""
    x, c0 = _init(spark, sf, K)
    coh = KM.cohesion(KM.assign(x, "x", c0))
    overall = coh.agg(F.lit(-1).alias("k"), F.sum("n").cast("long").alias("n"),
                      F.avg("cohesion").alias("cohesion"))
    return coh.unionByName(overall).select("k", "n", r("cohesion", 8).alias("cohesion"))


@query("kmeans_fit", sql=f"""
{_km_sql(K, 2)}
SELECT k, pos, {rs('v', 8)} AS value FROM c2""")
def kmeans_fit(spark, sf):
    """K5: three rounds from the fixed initialisation; the last assigns without
    an update, so two updates are made."""
    x, c0 = _init(spark, sf, K)
    res = KM.fit(x, "x", EMB_DIMS, c0, max_iters=3, tol=None)
    return KM.centroid_table(spark, res.centroids).select("k", "pos", r("value", 8).alias("value"))


@query("kmeans_quantise", sql=f"""
{_km_sql(QK, 1)}, {_assign_sql('q', 'c1')}
SELECT vec_id, k, {rs('d2', 8)} AS d2 FROM q""")
def kmeans_quantise(spark, sf):
    """K6: fit 16 centroids (2 rounds, one update) and replace every vector by its
    centroid; reports the centroid id and the distortion."""
    x, c0 = _init(spark, sf, QK)
    res = KM.fit(x, "x", EMB_DIMS, c0, max_iters=2, tol=None)
    q = KM.quantise(x, "x", res.centroids)
    return q.select("vec_id", "k", r("d2", 8).alias("d2"))


@query("kmeans_members", sql=f"""
{_km_sql(K, 2)}, {_assign_sql('q', 'c2')}
SELECT vec_id, {rs('d2', 8)} AS d2 FROM q WHERE k = 0""")
def kmeans_members(spark, sf):
    """K7: the members of cluster 0 of the fitted model (labels match the
    centroids that kmeans_fit returns)."""
    x, c0 = _init(spark, sf, K)
    res = KM.fit(x, "x", EMB_DIMS, c0, max_iters=3, tol=None)
    return KM.members(KM.assign(x, "x", res.centroids), 0).select("vec_id", r("d2", 8).alias("d2"))


# ---------------------------------------------------------------- PCA
def _emb_normaliser(x):
    xc = F.col("x")
    aggs = []
    for i in range(EMB_DIMS):
        aggs += [F.avg(xc[i]).alias(f"m{i}"), F.stddev_pop(xc[i]).alias(f"s{i}")]
    row = x.agg(*aggs).first()
    return ([row[f"m{i}"] for i in range(EMB_DIMS)], [row[f"s{i}"] for i in range(EMB_DIMS)])


@query("pca_cov", sql=f"""
WITH {_E},
st AS (SELECT pos, avg(v) AS mu, stddev_pop(v) AS sd FROM e GROUP BY pos),
z AS (SELECT e.vec_id, e.pos, (e.v - st.mu) / st.sd AS z FROM e JOIN st ON st.pos = e.pos)
SELECT a.pos AS i, b.pos AS j, {rs('sum(a.z * b.z) / (SELECT count(*) FROM embeddings)', 8)} AS value
FROM z a JOIN z b ON a.vec_id = b.vec_id AND a.pos <= b.pos GROUP BY a.pos, b.pos""")
def pca_cov(spark, sf):
    """X'X/m of the normalised 64-d embeddings (Arrow partial products
    per partition, summed by (i, j))."""
    x = emb(spark, sf)
    mu, sd = _emb_normaliser(x)
    cov = PC.covariance_long(x, "x", EMB_DIMS, mu, sd)
    return cov.select("i", "j", r("value", 8).alias("value"))


_P2 = (f"z AS (SELECT l_orderkey, l_linenumber, (x1 - m1) / s1 AS a, (y - m2) / s2 AS b FROM ({LI_SQL}), "
       f"(SELECT avg(x1) AS m1, stddev_pop(x1) AS s1, avg(y) AS m2, stddev_pop(y) AS s2 FROM ({LI_SQL}))),\n"
       "cv AS (SELECT avg(a * a) AS c11, avg(a * b) AS c12, avg(b * b) AS c22 FROM z),\n"
       "ev AS (SELECT (c11 + c22) / 2 + sqrt(((c11 - c22) / 2) * ((c11 - c22) / 2) + c12 * c12) AS l1,\n"
       "  (c11 + c22) / 2 - sqrt(((c11 - c22) / 2) * ((c11 - c22) / 2) + c12 * c12) AS l2, c11, c12 FROM cv),\n"
       "vv AS (SELECT l1, l2, c12 / sqrt(c12 * c12 + (l1 - c11) * (l1 - c11)) AS p1,\n"
       "  (l1 - c11) / sqrt(c12 * c12 + (l1 - c11) * (l1 - c11)) AS p2,\n"
       "  c12 / sqrt(c12 * c12 + (l2 - c11) * (l2 - c11)) AS q1,\n"
       "  (l2 - c11) / sqrt(c12 * c12 + (l2 - c11) * (l2 - c11)) AS q2 FROM ev),\n"
       "u AS (SELECT l1, l2, sign(p1) * p1 AS u11, sign(p1) * p2 AS u21,\n"
       "  sign(q1) * q1 AS u12, sign(q1) * q2 AS u22 FROM vv)")


def _pca2(spark, sf):
    d = li_design(spark, sf)
    nm = FT.fit_normalizer(d, ["x1", "y"])
    z = FT.normalize(d, nm).select("l_orderkey", "l_linenumber", F.col("x1").alias("a"),
                                   F.col("y").alias("b"))
    model = PC.directions(PC.covariance(z, ["a", "b"]))
    return z, model


@query("pca_2d", sql=f"""
WITH {_P2}
SELECT 1 AS k, {rs('l1', 8)} AS eigenvalue, {rs('u11', 8)} AS u1, {rs('u21', 8)} AS u2 FROM u
UNION ALL SELECT 2, {rs('l2', 8)}, {rs('u12', 8)}, {rs('u22', 8)} FROM u""")
def pca_2d(spark, sf):
    """Principal directions and eigenvalues of the 2-d covariance."""
    _, m = _pca2(spark, sf)
    rows = [(k + 1, float(m.S[k]), float(m.U[0, k]), float(m.U[1, k])) for k in range(2)]
    return spark.createDataFrame(rows, "k int, eigenvalue double, u1 double, u2 double") \
        .select("k", *[r(c, 8).alias(c) for c in ["eigenvalue", "u1", "u2"]])


@query("pca_retained", sql=f"""
WITH {_P2}
SELECT 1 AS k, {rs('100.0 * l1 / (l1 + l2)', 8)} AS retained_pct,
       CASE WHEN 100.0 * l1 / (l1 + l2) >= 95.0 THEN 1 ELSE 2 END AS min_k_95 FROM u
UNION ALL SELECT 2, 100.0, CASE WHEN 100.0 * l1 / (l1 + l2) >= 95.0 THEN 1 ELSE 2 END FROM u""")
def pca_retained(spark, sf):
    """Retained variance per number of components, and the smallest
    number of components keeping 95 %."""
    _, m = _pca2(spark, sf)
    ret = m.retained()
    kmin = m.min_components(95.0)
    rows = [(k + 1, float(ret[k]), kmin) for k in range(2)]
    return spark.createDataFrame(rows, "k int, retained_pct double, min_k_95 int") \
        .select("k", r("retained_pct", 8).alias("retained_pct"), "min_k_95")


@query("pca_project", sql=f"""
WITH {_P2}
SELECT l_orderkey, l_linenumber, {rs('a * u11 + b * u21', 6)} AS z1 FROM z, u""")
def pca_project(spark, sf):
    """Projection on the first principal direction."""
    z, m = _pca2(spark, sf)
    (z1,) = PC.project(["a", "b"], m, 1)
    return z.select("l_orderkey", "l_linenumber", r(z1, 6).alias("z1"))


@query("pca_reconstruct", sql=f"""
WITH {_P2}
SELECT l_orderkey, l_linenumber, {rs('(a * u11 + b * u21) * u11', 6)} AS r1,
       {rs('(a * u11 + b * u21) * u21', 6)} AS r2 FROM z, u""")
def pca_reconstruct(spark, sf):
    """Reconstruction from one component."""
    z, m = _pca2(spark, sf)
    (z1,) = PC.project(["a", "b"], m, 1)
    rec = PC.reconstruct([z1], m)
    return z.select("l_orderkey", "l_linenumber", r(rec[0], 6).alias("r1"), r(rec[1], 6).alias("r2"))


@query("pca_cost", sql=f"""
WITH {_P2}
SELECT {rs('avg(power(a - (a * u11 + b * u21) * u11, 2) + power(b - (a * u11 + b * u21) * u21, 2))', 8)} AS cost
FROM z, u""")
def pca_cost(spark, sf):
    """Mean squared reconstruction error with one component."""
    z, m = _pca2(spark, sf)
    return PC.cost(z, ["a", "b"], m, 1).select(r("cost", 8).alias("cost"))


# ---------------------------------------------------------------- wide and sparse
@query("pca_wide")
def pca_wide(spark, sf):
    """D2/D5 on the 64-d vectors: the 4 leading directions by block subspace
    iteration, and every vector's projection on them."""
    x = emb(spark, sf)
    model = PC.subspace(x, "x", 4)
    return PC.project_array(x.select("vec_id", "x"), "x", model, 4).select("vec_id", F.posexplode("z").alias("component", "z"))


@query("pca_terms")
def pca_terms(spark, sf):
    """D2 on the tf-idf of all documents: the 3 leading directions over terms
    (no term x term matrix), as (component, term, weight)."""
    from keelson.operators import text as TX
    from keelson.operators.lookup import deal
    docs = table(spark, sf, "documents").select("doc_id", "text")
    entries = TX.n_entries(docs, "text")
    dealt = deal(TX.count_lists(docs, "doc_id", "text"), entries)
    return PC.sparse_subspace(TX.tfidf_lists(dealt, TX.idf_values(dealt, docs.count())), 3, iters=6, entries=entries).table()
