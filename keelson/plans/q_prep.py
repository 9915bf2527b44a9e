"""Queries for sources, row shaping, scalar functions and feature
preparation (S2, S4, S8, S9, P3-P12, F1-F2, Z1-Z8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.expr import monomial_exponents, sigmoid, sigmoid_prime
from keelson.operators import features as FT
from keelson.plans.base import query, r, rs, table
from keelson.plans.data import LI_SQL, li_design
from keelson.sources import readers

NORM_COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


# ---------------------------------------------------------------- sources
@query("scan_features", sql="""
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice AS y
FROM lineitem""")
def scan_features(spark, sf):
    """Feature table scan with projection pushed to Parquet."""
    return readers.read_feature_table(
        spark, f"{sf}/lineitem.parquet", ["l_quantity", "l_discount", "l_tax"],
        label="l_extendedprice", keep=["l_orderkey", "l_linenumber"], label_as="y")


@query("item_names", sql="""
SELECT CAST(p_partkey AS BIGINT) AS item_id, trim(p_name) AS title FROM part""")
def item_names(spark, sf):
    """Parse 'id title' lines (built from part rows) into (item_id, title)."""
    lines = table(spark, sf, "part").select(
        F.concat_ws(" ", F.col("p_partkey").cast("string"), F.col("p_name")).alias("value"))
    return readers.parse_item_lines(lines)


@query("json_extract", sql="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_extract(spark, sf):
    """JSON text column -> typed struct field."""
    return readers.json_fields(table(spark, sf, "events"), "props", "k bigint",
                               keep=["event_id"])


@query("json_build", sql="""
SELECT event_id, CAST(to_json({'event_id': event_id, 'event_type': event_type, 'value': value}) AS VARCHAR) AS json
FROM events""")
def json_build(spark, sf):
    """Rows -> JSON text."""
    return readers.to_json_column(table(spark, sf, "events"), ["event_id", "event_type", "value"],
                                  keep=["event_id"], out="json")


# ---------------------------------------------------------------- row shaping
@query("one_hot", sql="""
SELECT l_orderkey, l_linenumber, l_returnflag,
  CAST(l_returnflag = 'A' AS DOUBLE) AS l_returnflag_A,
  CAST(l_returnflag = 'N' AS DOUBLE) AS l_returnflag_N,
  CAST(l_returnflag = 'R' AS DOUBLE) AS l_returnflag_R
FROM lineitem""")
def one_hot(spark, sf):
    """Class id -> K indicator columns (classes discovered, size-checked)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return FT.one_hot(li, "l_returnflag")


@query("explode_features", sql="""
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
       CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings""")
def explode_features(spark, sf):
    """Array column -> (id, pos, value) rows."""
    return FT.explode_features(table(spark, sf, "embeddings"), "vec_id", "embedding")


@query("sample_rows", sql="""
SELECT event_id, user_id, event_type, value FROM events
ORDER BY (event_id * 48271 + 17) % 2147483647, event_id LIMIT 100""")
def sample_rows(spark, sf):
    """P10: 100 rows in a seeded pseudo-random order (the sampling operator)."""
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return FT.sample_rows(ev, 100, "event_id", seed=17)


@query("grid_2d", sql=f"""
WITH rg AS (SELECT min(l_quantity) lo1, max(l_quantity) hi1, min(l_discount) lo2,
                   max(l_discount) hi2 FROM lineitem)
SELECT CAST(i.range AS INTEGER) AS i, CAST(j.range AS INTEGER) AS j,
       {rs('lo1 + i.range * ((hi1 - lo1) / 29.0)')} AS x1,
       {rs('lo2 + j.range * ((hi2 - lo2) / 29.0)')} AS x2
FROM rg, range(30) i, range(30) j""")
def grid_2d(spark, sf):
    """30 x 30 grid spanning the data range of two features."""
    li = table(spark, sf, "lineitem")
    (lo1, hi1), (lo2, hi2) = FT.data_range(li, ["l_quantity", "l_discount"])
    g = FT.grid_2d(spark, (lo1, hi1), (lo2, hi2), 30)
    return g.select("i", "j", r("x1").alias("x1"), r("x2").alias("x2"))


@query("classes", sql="""
SELECT l_returnflag AS class, CAST(dense_rank() OVER (ORDER BY l_returnflag) - 1 AS INTEGER)
  AS class_index
FROM (SELECT DISTINCT l_returnflag FROM lineitem)""")
def classes(spark, sf):
    """Sorted distinct labels with their index."""
    return FT.classes_table(table(spark, sf, "lineitem"), "l_returnflag")


# ---------------------------------------------------------------- scalar functions
@query("sigmoid", sql=f"""
SELECT event_id, {rs('(value - 50.0) / 10.0', 8)} AS z,
  {rs('1.0 / (1.0 + exp(-((value - 50.0) / 10.0)))', 8)} AS s,
  {rs('(1.0 / (1.0 + exp(-((value - 50.0) / 10.0)))) * (1.0 - 1.0 / (1.0 + exp(-((value - 50.0) / 10.0))))', 8)} AS s_prime
FROM events""")
def sigmoid_q(spark, sf):
    """sigmoid and its derivative of a standardised event value."""
    ev = table(spark, sf, "events")
    z = (F.col("value") - 50.0) / 10.0
    return ev.select("event_id", r(z, 8).alias("z"), r(sigmoid(z), 8).alias("s"),
                     r(sigmoid_prime(z), 8).alias("s_prime"))


# ---------------------------------------------------------------- normaliser
def _norm_fit_sql():
    parts = [f"SELECT '{c}' AS feature, {rs(f'avg({c})')} AS mu, {rs(f'stddev_pop({c})')} AS sigma "
             f"FROM lineitem" for c in NORM_COLS]
    return "\nUNION ALL\n".join(parts)


@query("normalizer_fit", sql=_norm_fit_sql())
def normalizer_fit(spark, sf):
    """Per-feature mean and population sd as a model table."""
    li = table(spark, sf, "lineitem")
    m = FT.fit_normalizer(li, NORM_COLS)
    return m.table(spark).select("feature", r("mu").alias("mu"), r("sigma").alias("sigma"))


_Z = ["l_quantity", "l_discount", "l_tax"]
_STATS = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in _Z)


@query("normalize", sql=f"""
WITH s AS (SELECT {_STATS} FROM lineitem)
SELECT l_orderkey, l_linenumber,
  {', '.join(rs(f'({c} - mu_{c}) / sd_{c}') + f' AS z_{c[2:]}' for c in _Z)}
FROM lineitem, s""")
def normalize(spark, sf):
    """Apply the fitted normaliser to every row."""
    li = table(spark, sf, "lineitem")
    m = FT.fit_normalizer(li, _Z)
    out = FT.normalize(li, m, suffix="_z")
    return out.select("l_orderkey", "l_linenumber",
                      *[r(f"{c}_z").alias(f"z_{c[2:]}") for c in _Z])


@query("denormalize", sql=f"""
SELECT l_orderkey, l_linenumber, {', '.join(rs(c) + ' AS ' + c for c in _Z)} FROM lineitem""")
def denormalize(spark, sf):
    """Z3: normalise then invert: the original values come back."""
    li = table(spark, sf, "lineitem")
    m = FT.fit_normalizer(li, _Z)
    back = FT.denormalize(FT.normalize(li, m), m)
    return back.select("l_orderkey", "l_linenumber", *[r(c).alias(c) for c in _Z])


def _isnorm_sql(src, cols):
    conds = " AND ".join(f"abs(avg({c})) <= 1e-8 AND abs(stddev_pop({c}) - 1.0) <= 1e-8 + 1e-5"
                         for c in cols)
    return f"SELECT ({conds}) AS is_normalized FROM {src}"


@query("is_normalized", sql=f"""
SELECT 'raw' AS dataset, * FROM ({_isnorm_sql('lineitem', _Z)})
UNION ALL
SELECT 'normalized' AS dataset, * FROM ({_isnorm_sql(
    f"(SELECT {', '.join(f'({c} - mu_{c}) / sd_{c} AS {c}' for c in _Z)} FROM lineitem, "
    f"(SELECT {_STATS} FROM lineitem) s)", _Z)})""")
def is_normalized(spark, sf):
    """Is the table normalised?  Raw: no; after Z2: yes."""
    li = table(spark, sf, "lineitem")
    m = FT.fit_normalizer(li, _Z)
    raw = li.agg(FT.is_normalized_expr(_Z).alias("is_normalized")) \
            .select(F.lit("raw").alias("dataset"), "is_normalized")
    nrm = FT.normalize(li, m).agg(FT.is_normalized_expr(_Z).alias("is_normalized")) \
            .select(F.lit("normalized").alias("dataset"), "is_normalized")
    return raw.unionByName(nrm)


# ---------------------------------------------------------------- polynomial maps
def _mono_sql(names, exps):
    parts = []
    for n, e in zip(names, exps):
        parts += [n] * e
    return "1.0" if not parts else " * ".join(parts)


def _poly_sql(degree, prefix):
    exps = monomial_exponents(2, degree)
    cols = ", ".join(f"{rs(_mono_sql(['x1', 'x2'], e))} AS {prefix}{i}" for i, e in enumerate(exps))
    return f"SELECT l_orderkey, l_linenumber, {cols} FROM ({LI_SQL})"


@query("polymap", sql=_poly_sql(3, "p"))
def polymap(spark, sf):
    """All monomials of degree <= 3 in (x1, x2), documented order."""
    d = li_design(spark, sf)
    out = FT.polymap(d, ["x1", "x2"], 3, keep=["l_orderkey", "l_linenumber"], prefix="p")
    return out.select("l_orderkey", "l_linenumber",
                      *[r(c).alias(c) for c in out.columns if c.startswith("p")])


@query("map_feature", sql=_poly_sql(6, "f"))
def map_feature(spark, sf):
    """The 28-column degree-6 two-feature map."""
    d = li_design(spark, sf)
    out = FT.map_feature(d, "x1", "x2", 6, keep=["l_orderkey", "l_linenumber"], prefix="f")
    return out.select("l_orderkey", "l_linenumber",
                      *[r(c).alias(c) for c in out.columns if c.startswith("f")])


@query("poly_features", sql=f"""
SELECT l_orderkey, l_linenumber, {', '.join(
    (rs('x1') if k == 1 else rs(f'pow(x1, {k}.0)')) + f' AS x{k}' for k in range(1, 9))}
FROM ({LI_SQL})""")
def poly_features(spark, sf):
    """X, x^2, .., x^8 of one feature."""
    d = li_design(spark, sf)
    out = FT.poly_features(d, "x1", 8, keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", *[r(f"x{k}").alias(f"x{k}") for k in range(1, 9)])


@query("equalize_hist", sql=f"""
WITH mm AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
                   (max(l_extendedprice) - min(l_extendedprice)) / 256.0 AS w,
                   count(*) AS n FROM lineitem),
bins AS (SELECT least(floor((l_extendedprice - lo) * 256.0 / (hi - lo)), 255) AS b
         FROM lineitem, mm),
h AS (SELECT b, count(*) AS c FROM bins GROUP BY b),
g AS (SELECT range AS b FROM range(256)),
cdf AS (SELECT g.b, sum(coalesce(h.c, 0)) OVER (ORDER BY g.b) / (SELECT n FROM mm) AS p
        FROM g LEFT JOIN h ON h.b = g.b),
x AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS v,
             CAST(floor((l_extendedprice - (lo + 0.5 * w)) / w) AS INTEGER) AS j,
             lo, w FROM lineitem, mm)
SELECT l_orderkey, l_linenumber, {rs('''CASE WHEN v <= lo + 0.5 * w THEN (SELECT p FROM cdf WHERE b = 0)
  WHEN v >= lo + (256 - 0.5) * w THEN (SELECT p FROM cdf WHERE b = 255)
  ELSE c1.p + (c2.p - c1.p) * (v - (lo + (j + 0.5) * w)) / w END''')} AS eq
FROM x LEFT JOIN cdf c1 ON c1.b = x.j LEFT JOIN cdf c2 ON c2.b = x.j + 1""")
def equalize_hist(spark, sf):
    """Histogram equalisation of the extended price over all rows."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = FT.equalize_hist(li, "l_extendedprice", out="eq")
    return out.select("l_orderkey", "l_linenumber", r("eq").alias("eq"))
