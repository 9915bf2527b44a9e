"""Feature preparation: normaliser, polynomial maps, histogram equalisation,
one-hot, reshaping, deterministic sampling, grids, class lists.

Fits are single aggregation jobs; the fitted parameters are inlined as
literals so that applying them is a narrow, codegen'd projection (batch or
stream)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete, monomial, monomial_exponents

@dataclass
class Normalizer:
    """Per-column mean and standard deviation (population sd for ddof=0)."""
    cols: list[str]
    mu: list[float]
    sigma: list[float]
    ddof: int = 0

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(c, float(m), float(s)) for c, m, s in zip(self.cols, self.mu, self.sigma)],
            "feature string, mu double, sigma double")

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return normalize(df, self, suffix)


def fit_normalizer(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> Normalizer:
    """One aggregate of avg and stddev for every column, over the complete
    rows."""
    df = complete(df, cols)
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(col(c)).alias(f"mu_{i}"), sd(col(c)).alias(f"sd_{i}")]
    row = df.agg(*aggs).first()
    mu = [float(row[f"mu_{i}"]) for i in range(len(cols))]
    sigma = [float(row[f"sd_{i}"] or 0.0) for i in range(len(cols))]
    return Normalizer(list(cols), mu, sigma, ddof)


def normalize_expr(c: Column | str, mu: float, sigma: float) -> Column:
    """(x - mu) / sigma; a constant column (sigma = 0) is left unchanged."""
    if sigma == 0.0:
        return col(c)
    return (col(c) - F.lit(mu)) / F.lit(sigma)


def normalize(df: DataFrame, model: Normalizer, suffix: str = "") -> DataFrame:
    """Apply a fitted normaliser (works on streaming frames too)."""
    return df.withColumns({c + suffix: normalize_expr(c, m, s)
                           for c, m, s in zip(model.cols, model.mu, model.sigma)})


def denormalize(df: DataFrame, model: Normalizer, suffix: str = "") -> DataFrame:
    """Z3: x_n * sigma + mu (constant columns pass through)."""
    out = {}
    for c, m, s in zip(model.cols, model.mu, model.sigma):
        out[c + suffix] = col(c) if s == 0.0 else col(c) * F.lit(s) + F.lit(m)
    return df.withColumns(out)


def is_normalized_expr(cols: Sequence[str], atol: float = 1e-8, rtol: float = 1e-5) -> Column:
    """Z4 aggregate: every mean ~ 0 and every population sd ~ 1."""
    checks = []
    for c in cols:
        checks.append(F.abs(F.avg(col(c))) <= F.lit(atol))
        checks.append(F.abs(F.stddev_pop(col(c)) - F.lit(1.0)) <= F.lit(atol + rtol))
    out = checks[0]
    for c in checks[1:]:
        out = out & c
    return out


def is_normalized(df: DataFrame, cols: Sequence[str]) -> bool:
    return bool(df.agg(is_normalized_expr(cols).alias("ok")).first()["ok"])


def polymap_columns(cols: Sequence[Column | str], degree: int | None, bias: bool = True,
                    prefix: str = "p") -> list[Column]:
    """All monomials of total degree <= degree in the documented order
    (1, x, y, x^2, xy, y^2, ...).  ``degree=None`` is the identity map
    (with the bias column when ``bias``)."""
    if degree is None:
        out = ([F.lit(1.0).alias(f"{prefix}0")] if bias else [])
        return out + [col(c).cast("double").alias(f"{prefix}{i + (1 if bias else 0)}")
                      for i, c in enumerate(cols)]
    exps = monomial_exponents(len(cols), degree, bias=bias)
    return [monomial([col(c).cast("double") for c in cols], e).alias(f"{prefix}{i}")
            for i, e in enumerate(exps)]


def polymap(df: DataFrame, cols: Sequence[str], degree: int | None, keep: Sequence[str] = (),
            bias: bool = True, prefix: str = "p") -> DataFrame:
    return df.select(*keep, *polymap_columns(cols, degree, bias, prefix))


def map_feature(df: DataFrame, x1: str, x2: str, degree: int = 6, keep: Sequence[str] = (),
                prefix: str = "f") -> DataFrame:
    """The two-feature map (28 columns for degree 6); same order as Z5."""
    return polymap(df, [x1, x2], degree, keep=keep, prefix=prefix)


def poly_features(df: DataFrame, x: str, p: int, keep: Sequence[str] = (),
                  prefix: str = "x") -> DataFrame:
    """X, x^2, .., x^p (no bias)."""
    c = col(x).cast("double")
    return df.select(*keep, *[F.pow(c, F.lit(float(k))).alias(f"{prefix}{k}") if k > 1
                              else c.alias(f"{prefix}1") for k in range(1, p + 1)])


def equalize_hist(df: DataFrame, x: str, out: str = "eq", nbins: int = 256) -> DataFrame:
    """Histogram equalisation over *all* rows together.

    Bins: b = least(floor((x - min) * nbins / (max - min)), nbins - 1).  The
    cumulative share of each bin is interpolated linearly between bin
    centres.  Jobs: one min/max aggregate, one grouped count with at most
    ``nbins`` groups (partial aggregation), then a projection with the
    ``nbins`` cumulative shares inlined.  Null and NaN values are in no bin and
    give null; without any value the column is null."""
    c = F.nanvl(col(x).cast("double"), F.lit(None).cast("double"))
    r = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
    if r["lo"] is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    lo, hi = float(r["lo"]), float(r["hi"])
    if hi == lo:
        return df.withColumn(out, F.when(c.isNotNull(), F.lit(1.0)))
    span = hi - lo
    w = span / nbins
    b = F.floor((c - F.lit(lo)) * F.lit(float(nbins)) / F.lit(span))
    b = F.when(b >= nbins, F.lit(nbins - 1)).otherwise(b)
    hist = {int(row["b"]): int(row["n"]) for row in
            df.filter(c.isNotNull()).groupBy(b.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = float(sum(hist.values()))
    cdf, acc = [], 0
    for i in range(nbins):
        acc += hist.get(i, 0)
        cdf.append(acc / total)
    cdf_arr = F.array(*[F.lit(v) for v in cdf])
    c0 = lo + 0.5 * w
    j = F.floor((c - F.lit(c0)) / F.lit(w)).cast("int")
    cj = F.lit(lo) + (j.cast("double") + F.lit(0.5)) * F.lit(w)
    left = F.element_at(cdf_arr, j + 1)
    right = F.element_at(cdf_arr, j + 2)
    interp = left + (right - left) * (c - cj) / F.lit(w)
    val = (F.when(c <= F.lit(c0), F.lit(cdf[0]))
           .when(c >= F.lit(lo + (nbins - 0.5) * w), F.lit(cdf[-1]))
           .otherwise(interp))
    return df.withColumn(out, val)


def distinct_classes(df: DataFrame, label: str) -> list:
    """Sorted distinct labels (nulls are no class).  The list becomes
    columns or models, so it is for labels whose classes are a model's size;
    :func:`class_rows` is the form for any number of classes."""
    d = df.select(label).filter(F.col(label).isNotNull()).distinct()
    return sorted(r[0] for r in d.collect())


def classes_table(df: DataFrame, label: str) -> DataFrame:
    """P12 as a frame: (class, class_index) sorted, numbered without a
    single-task sort; nulls are no class."""
    from keelson.operators.indexing import global_row_index
    d = df.select(col(label).alias("class")).filter(F.col("class").isNotNull()).distinct()
    return global_row_index(d, ["class"], name="_n", start=0).select(
        "class", F.col("_n").cast("int").alias("class_index"))


def class_rows(df: DataFrame, id_col: str, label: str) -> DataFrame:
    """P6 in long form, for any number of classes: (id, class_index) of the
    one entry that is 1 in each row; rows without a class have none."""
    return (df.select(id_col, col(label).alias("class")).join(classes_table(df, label), "class")
            .select(id_col, "class_index"))


def one_hot(df: DataFrame, label: str, classes: Sequence | None = None,
            prefix: str | None = None) -> DataFrame:
    """K indicator columns, one per class (classes listed or discovered)."""
    classes = list(classes) if classes is not None else distinct_classes(df, label)
    prefix = prefix if prefix is not None else f"{label}_"
    return df.withColumns({f"{prefix}{c}": (col(label) == F.lit(c)).cast("double")
                           for c in classes})


def binarize(label: Column | str, cls) -> Column:
    """P5: 1.0 for the class, else 0.0."""
    return (col(label) == F.lit(cls)).cast("double")


def relabel(c: Column | str, mapping: dict) -> Column:
    """Conditional value map; unmapped values pass through."""
    out = None
    for k, v in mapping.items():
        out = (F.when(col(c) == F.lit(k), F.lit(v)) if out is None
               else out.when(col(c) == F.lit(k), F.lit(v)))
    return col(c) if out is None else out.otherwise(col(c))


def explode_features(df: DataFrame, id_col: str, arr: str, pos: str = "pos",
                     value: str = "value") -> DataFrame:
    """Array column -> long rows (id, pos, value), pos 0-based."""
    return df.select(id_col, F.posexplode(arr).alias(pos, value)) \
             .withColumn(value, F.col(value).cast("double"))


def implode_features(long_df: DataFrame, id_col: str, pos: str = "pos", value: str = "value",
                     out: str = "features") -> DataFrame:
    """P8 inverse: long rows -> ordered array per id."""
    return (long_df.groupBy(id_col)
            .agg(F.sort_array(F.collect_list(F.struct(pos, value))).alias("_kv"))
            .select(id_col, F.col(f"_kv.{value}").alias(out)))


def permutation_key(key: Column | str, seed: int = 17, modulus: int = 2_147_483_647) -> Column:
    """A deterministic pseudo-random order key: (key * a + seed) mod p, with
    p prime and a a primitive root, so distinct keys below p map to distinct
    values and the order looks random.  The key is reduced first, so no whole
    number overflows; keys that are no whole numbers count by their hash; null
    stays null."""
    k = col(key)
    number = F.coalesce(k.try_cast("long"), F.xxhash64(k))
    return F.when(k.isNotNull(), F.pmod(F.pmod(number, F.lit(modulus)) * F.lit(48271) + F.lit(seed), F.lit(modulus)))


def sample_rows(df: DataFrame, k: int, key: str, seed: int = 17) -> DataFrame:
    """P10: k rows in a seeded pseudo-random order (global top-k plan)."""
    return (df.withColumn("_perm", permutation_key(key, seed))
            .orderBy("_perm", key).limit(k).drop("_perm"))


def random_rows(df: DataFrame, k: int, seed: int = 17) -> DataFrame:
    """P10, random variant: ``rand(seed)`` order, first k."""
    return df.orderBy(F.rand(seed)).limit(k)


def linspace_expr(lo: float, hi: float, n: int, idx: Column) -> Column:
    step = (hi - lo) / (n - 1) if n > 1 else 0.0
    return F.lit(lo) + idx.cast("double") * F.lit(step)


def grid_2d(spark: SparkSession, x_range: tuple[float, float], y_range: tuple[float, float],
            n: int, names=("x1", "x2")) -> DataFrame:
    """N x n grid of linspace points, generated by two explodes
    (no join).  Columns i, j, x1, x2."""
    i, j = F.col("i"), F.col("j")
    return (spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
            .select("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j"))
            .select(i, j, linspace_expr(x_range[0], x_range[1], n, i).alias(names[0]),
                    linspace_expr(y_range[0], y_range[1], n, j).alias(names[1])))


def data_range(df: DataFrame, cols: Sequence[str]) -> list[tuple[float, float]]:
    aggs = []
    for k, c in enumerate(cols):
        aggs += [F.min(col(c)).alias(f"lo{k}"), F.max(col(c)).alias(f"hi{k}")]
    r = df.agg(*aggs).first()
    return [(float(r[f"lo{k}"]), float(r[f"hi{k}"])) for k in range(len(cols))]
