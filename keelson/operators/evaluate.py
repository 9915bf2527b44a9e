"""Evaluation and model selection.

Additive models (least squares / ridge) are cross-validated from grouped
sufficient statistics: one scan returns the Gram matrix of every fold, and
the training Gram of fold f is total - G_f.  Learning curves use a Gram per
size bucket plus a running sum, so every curve, fold and lambda costs one
scan of the data in total."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete
from keelson.operators import gram as G
from keelson.operators.features import permutation_key
from keelson.session import cut_lineage


def accuracy(df: DataFrame, pred: str, truth: str) -> DataFrame:
    """Share of hits, in percent."""
    return df.agg((F.avg((col(pred) == col(truth)).cast("double")) * 100.0).alias("accuracy_pct"))


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Counts by (truth, prediction) - partial aggregation, K^2 groups."""
    return df.groupBy(col(truth).alias("truth"), col(pred).alias("pred")) \
             .agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class plus the
    support-weighted average row (class 'weighted avg').  0/0 -> 0."""
    conf = confusion(df, truth, pred)
    per_truth = conf.groupBy(F.col("truth").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("truth") == F.col("pred"), F.col("n")).otherwise(0)).alias("tp"))
    per_pred = conf.groupBy(F.col("pred").alias("class")).agg(F.sum("n").alias("predicted"))
    rep = (per_truth.join(per_pred, "class", "full_outer")
           .na.fill(0, ["support", "tp", "predicted"]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    rep = rep.select(F.col("class").cast("string").alias("class"),
                     prec.alias("precision"), rec.alias("recall"),
                     F.col("support").cast("long").alias("support"))
    rep = rep.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    tot = rep.agg(F.lit("weighted avg").alias("class"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                  F.sum("support").cast("long").alias("support"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))
    return rep.unionByName(tot)


def log_loss(probs: DataFrame, id_col: str, class_col: str, p_col: str, truth_col: str,
             eps: float = 1e-15) -> DataFrame:
    """Mean -ln p(true class); probabilities are clipped to
    [eps, 1 - eps] and renormalised per row."""
    clipped = probs.withColumn("_p", F.least(F.greatest(col(p_col), F.lit(eps)), F.lit(1 - eps)))
    per_row = clipped.groupBy(id_col).agg(
        F.sum("_p").alias("_z"),
        F.sum(F.when(col(class_col) == col(truth_col), F.col("_p"))).alias("_pt"))
    return per_row.agg(F.avg(-F.log(F.col("_pt") / F.col("_z"))).alias("log_loss"))


def fold_of(key: Column | str, k: int, seed: int = 17) -> Column:
    """Deterministic fold id in [0, k) from a key (seeded permutation)."""
    return F.pmod(permutation_key(key, seed), F.lit(k)).cast("int")


def split(df: DataFrame, key: str, val_share_of: int = 5, seed: int = 17):
    """E5: deterministic train / validation split by key: one fold out of
    ``val_share_of`` is validation.  Returns (train, val)."""
    f = fold_of(key, val_share_of, seed)
    return df.filter(f != 0), df.filter(f == 0)


def split_label(key: str, val_share_of: int = 5, seed: int = 17) -> Column:
    return F.when(fold_of(key, val_share_of, seed) == 0, F.lit("val")).otherwise(F.lit("train"))


def kfold_ridge(df: DataFrame, cols: Sequence[str], y: str, fold: Column, k: int,
                lam: float = 0.0) -> list[dict]:
    """Out-of-fold ridge refits from ONE grouped Gram scan.

    Returns per fold: theta (trained on the other folds), n and the mean
    squared error on the fold, computed from the fold's own Gram."""
    grams = G.grouped_grams(df.withColumn("_fold", fold), cols, y, "_fold")
    total = sum(grams.values())
    out = []
    for f in range(k):
        Gf = grams.get(f)
        if Gf is None:
            continue
        theta = G.solve(total - Gf, lam)
        mse = 2.0 * G.cost(Gf, theta, 0.0)
        out.append({"fold": f, "n": int(Gf[0, 0]), "theta": theta, "mse": mse})
    return out


def kfold_predict(df: DataFrame, cols: Sequence[str], y: str, fold: Column, k: int, keep: Sequence[str],
                  lam: float = 0.0) -> DataFrame:
    """E6, rows: the out-of-fold prediction of every complete row, from the
    model trained on the other folds: (keep.., fold, y, pred)."""
    from keelson.functions.expr import linear
    rows = complete(df, [*cols, y]).withColumn("fold", fold)
    thetas = {f["fold"]: f["theta"] for f in kfold_ridge(rows, cols, y, F.col("fold"), k, lam)}
    pred = None
    for f, th in thetas.items():
        h = linear(cols, th[1:], intercept=th[0])
        pred = F.when(F.col("fold") == f, h) if pred is None else pred.when(F.col("fold") == f, h)
    return rows.select(*keep, "fold", col(y).alias("y"), (F.lit(None).cast("double") if pred is None else pred).alias("pred"))


def cv_score(folds: list[dict]) -> float:
    """Weighted mean of the fold errors (weights = fold sizes)."""
    n = sum(f["n"] for f in folds)
    return float(sum(f["mse"] * f["n"] for f in folds) / n)


def fold_mean(preds: DataFrame, id_cols: Sequence[str], p_col: str = "p") -> DataFrame:
    """Element-wise mean of several models' predictions."""
    return preds.groupBy(*id_cols).agg(F.avg(p_col).alias(p_col))


def kfold_frequency_models(df: DataFrame, feature: str, label: str, fold: Column, k: int,
                           classes: Sequence | None = None) -> DataFrame:
    """Per-fold class-frequency models P_f(class | feature value), Laplace
    smoothed, each trained without its fold, averaged over the folds (E7).

    One grouped count (fold x value x class, partial aggregation) is written
    once; everything else comes from that small table.  Returns (feature,
    class, p)."""
    cnt = cut_lineage(df.groupBy(fold.alias("fold"), col(feature).alias(feature), col(label).alias("class"))
                      .agg(F.count(F.lit(1)).alias("n")))
    if classes is None:
        classes = sorted(r[0] for r in cnt.select("class").filter("class IS NOT NULL").distinct().collect())
    K = len(classes)
    # per value: the counts of every class, in all and without each fold
    per = cnt.groupBy(feature).agg(F.sum("n").alias("nh"), F.collect_list(F.struct("fold", "class", "n")).alias("c"))
    total = lambda cond: F.aggregate(F.filter("c", cond), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    per = per.withColumn("class", F.explode(F.array(*[F.lit(c) for c in classes])))
    per = per.withColumn("nhc", total(lambda x: x["class"] == F.col("class")))

    def without(f: int) -> Column:
        held = total(lambda x: (x["class"] == F.col("class")) & (x["fold"] == f))
        return (F.col("nhc") - held + F.lit(1.0)) / (F.col("nh") - total(lambda x: x["fold"] == f) + F.lit(K))

    p = [without(f) for f in range(k)]
    mean = p[0]
    for x in p[1:]:
        mean = mean + x
    return per.select(feature, "class", (mean / F.lit(float(k))).alias("p"))


def fold_frequency_predict(df: DataFrame, id_col: str, feature: str, models: DataFrame,
                           keep: Sequence[str] = ()) -> DataFrame:
    """(id, class, p, keep..) for every row and class from the averaged models."""
    models = cut_lineage(models)
    return df.select(id_col, feature, *keep).join(models, feature).select(id_col, "class", "p", *keep)


def lambda_grid(df: DataFrame, cols: Sequence[str], y: str, fold: Column, k: int,
                lambdas: Sequence[float]) -> list[tuple[float, float]]:
    """E8 for ridge: cross-validated error for every lambda from the same
    fold Grams (one scan for the whole grid)."""
    grams = G.grouped_grams(df.withColumn("_fold", fold), cols, y, "_fold")
    total = sum(grams.values())
    out = []
    for lam in lambdas:
        folds = []
        for f, Gf in sorted(grams.items()):
            theta = G.solve(total - Gf, lam)
            folds.append({"n": Gf[0, 0], "mse": 2.0 * G.cost(Gf, theta, 0.0)})
        out.append((float(lam), cv_score(folds)))
    return out


def learning_curve(train: DataFrame, val: DataFrame, cols: Sequence[str], y: str,
                   order: Sequence[Column | str], sizes: Sequence[int],
                   lam: float = 0.0) -> list[tuple[int, float, float]]:
    """For each size i, fit on the first i training rows (in ``order``)
    and report training and validation error (errors without the penalty).

    The last point is always all training rows; larger sizes are left out.
    Only the order key, X and y are sorted; each row falls into the first size
    bucket that contains it, the Gram of every bucket comes from one grouped
    aggregate, and prefix Grams are running sums."""
    from keelson.operators.indexing import global_row_index
    slim = complete(train, [*cols, y]).select(*order, *[col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(cols)],
                                              col(y).cast("double").alias("_cy"))
    idx = global_row_index(slim, order, name="_rn")
    m = int(idx.agg(F.max("_rn")).first()[0] or 0)
    sizes = sorted({int(s) for s in sizes if s < m} | ({m} if m else set()))
    if not sizes:
        return []
    bucket = F.lit(sizes[-1])
    for s in reversed(sizes[:-1]):
        bucket = F.when(F.col("_rn") <= s, F.lit(s)).otherwise(bucket)
    names = [f"_c{i}" for i in range(len(cols))]
    grams = G.grouped_grams(idx.withColumn("_b", bucket), names, "_cy", "_b")
    Gv = G.gram(val, cols, y)
    out, acc = [], None
    for s in sizes:
        acc = grams[s] if acc is None else acc + grams[s]
        theta = G.solve(acc, lam)
        out.append((s, G.cost(acc, theta, 0.0), G.cost(Gv, theta, 0.0)))
    return out


def doubling_sizes(start: int = 10, stop: int = 2 ** 62) -> list[int]:
    """1-2-5 sizes from ``start`` on, far beyond any table (see learning_curve)."""
    out, ten = [], start
    while ten <= stop:
        out += [ten, 2 * ten, 5 * ten]
        ten *= 10
    return out


def validation_curve(train: DataFrame, val: DataFrame, cols: Sequence[str], y: str,
                     lambdas: Sequence[float]) -> list[tuple[float, float, float]]:
    """Training / validation error for each lambda (two Gram scans)."""
    Gt, Gv = G.gram(train, cols, y), G.gram(val, cols, y)
    out = []
    for lam in lambdas:
        theta = G.solve(Gt, lam)
        out.append((float(lam), G.cost(Gt, theta, 0.0), G.cost(Gv, theta, 0.0)))
    return out


def r2(df: DataFrame, pred: Column, y: str) -> DataFrame:
    """1 - SSE/SST."""
    from keelson.operators.linear import r2_frame
    return r2_frame(df, pred, y)


def poly_grid_search(df: DataFrame, x: str, y: str, fold: Column, k: int,
                     degrees: Sequence[int], lambdas: Sequence[float]) -> list[tuple]:
    """E8 (general): cross-validated ridge over polynomial degree x lambda.

    Powers are normalised with the training statistics of each fold taken
    from the same Gram; the Gram of the highest degree contains every lower
    degree as a sub-block, so the whole grid costs one grouped scan."""
    dmax = max(degrees)
    powers = [F.pow(col(x).cast("double"), F.lit(float(p))) for p in range(1, dmax + 1)]
    names = [f"_p{p}" for p in range(1, dmax + 1)]
    wide = df.select(*[c.alias(n) for c, n in zip(powers, names)], col(y).alias("_y"),
                     fold.alias("_fold"))
    grams = G.grouped_grams(wide, names, "_y", "_fold")
    total = sum(grams.values())
    results = []
    for d in degrees:
        sub = list(range(0, d + 1)) + [dmax + 1]
        for lam in lambdas:
            folds = []
            for f, Gf in sorted(grams.items()):
                Gt = (total - Gf)[np.ix_(sub, sub)]
                Gs = Gf[np.ix_(sub, sub)]
                Zt, Zs = _standardise(Gt), None
                T = Zt
                theta = G.solve(T.T @ Gt @ T, lam)
                Zs = T.T @ Gs @ T
                folds.append({"n": Gs[0, 0], "mse": 2.0 * G.cost(Zs, theta, 0.0)})
            results.append((d, float(lam), cv_score(folds)))
    return results


def _standardise(Gt: np.ndarray) -> np.ndarray:
    """Linear map T so that T' G T is the Gram of z-scored features (from
    the training Gram itself): z_j = (x_j - mu_j)/sd_j; bias and target are
    kept."""
    k = Gt.shape[0]
    m = Gt[0, 0]
    mu = Gt[0, 1:k - 1] / m
    var = np.diag(Gt)[1:k - 1] / m - mu ** 2
    sd = np.sqrt(np.maximum(var, 1e-300))
    T = np.eye(k)
    for j in range(1, k - 1):
        T[j, j] = 1.0 / sd[j - 1]
        T[0, j] = -mu[j - 1] / sd[j - 1]
    return T
