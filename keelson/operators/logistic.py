"""Logistic regression and one-vs-all.

Fitting is damped Newton: each pass sums loss, gradient and Hessian of all
models (classes, and folds left out) that are still moving, as numpy products
per partition added by key; the (n+1)^2 systems are solved on the driver.  Named columns and array
features of any width run the same way."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import argmax_index, col, complete, complete_vector, linear, log_loss_margin, sigmoid
from keelson.operators.features import distinct_classes, polymap_columns


def score(cols: Sequence[Column | str], theta: Sequence[float]) -> Column:
    """z = theta_0 + sum theta_j x_j (theta_0 multiplies the bias)."""
    return linear(cols, theta[1:], intercept=theta[0])


def hypothesis(cols: Sequence[Column | str], theta: Sequence[float]) -> Column:
    """sigmoid(X theta)."""
    return sigmoid(score(cols, theta))


def cost_expr(cols, y, theta, lam: float) -> Column:
    """C2 aggregate: mean cross-entropy + lam/2m sum_{j>=1} theta_j^2."""
    reg = float(sum(t * t for t in theta[1:]))
    loss = log_loss_margin(score(cols, theta), y)
    loss = F.when(~F.isnan(loss), loss)     # null in a row with a missing value
    return (F.sum(loss) + F.lit(lam * reg / 2.0)) / F.count(loss)


def gradient_frame(df: DataFrame, cols: Sequence[str], y: str, theta: Sequence[float],
                   lam: float = 0.0) -> DataFrame:
    """X'(h - y)/m + lam/m [0; theta_1..] as (idx, grad)."""
    e = hypothesis(cols, theta) - col(y)
    xs = [F.lit(1.0)] + [col(c) for c in cols]
    m = F.count(F.lit(1))
    aggs = [((F.sum(e * x) + F.lit(0.0 if j == 0 else lam * theta[j])) / m).alias(f"g{j}")
            for j, x in enumerate(xs)]
    return complete(df, [*cols, y]).agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(j).alias("idx"), F.col(f"g{j}").alias("grad")) for j in range(len(xs))])))


def numeric_gradient_frame(df: DataFrame, cols: Sequence[str], y: str, theta: Sequence[float],
                           lam: float = 0.0, eps: float = 1e-4) -> DataFrame:
    """N7 for the logistic cost: central differences (J(t + eps e_j) -
    J(t - eps e_j)) / 2 eps beside the analytic gradient, for every j.  All
    2P perturbed costs and the P gradient sums are ONE aggregate (one scan,
    no per-perturbation job and no join)."""
    P = len(theta)
    xs = [F.lit(1.0)] + [col(c).cast("double") for c in cols]
    yy = col(y).cast("double")
    aggs = [F.count(F.lit(1)).alias("m")]
    regs = []
    for j in range(P):
        tp, tm = list(theta), list(theta)
        tp[j] += eps
        tm[j] -= eps
        regs.append((sum(t * t for t in tp[1:]), sum(t * t for t in tm[1:])))
        aggs.append(F.sum(log_loss_margin(linear(xs, tp), yy)).alias(f"lp{j}"))
        aggs.append(F.sum(log_loss_margin(linear(xs, tm), yy)).alias(f"lm{j}"))
    e = sigmoid(linear(xs, theta)) - yy
    aggs += [F.sum(e * x).alias(f"g{j}") for j, x in enumerate(xs)]
    wide = complete(df, [*cols, y]).agg(*aggs)
    m = F.col("m")
    rows = []
    for j in range(P):
        jp = (F.col(f"lp{j}") + F.lit(lam * regs[j][0] / 2.0)) / m
        jm = (F.col(f"lm{j}") + F.lit(lam * regs[j][1] / 2.0)) / m
        an = (F.col(f"g{j}") + F.lit(0.0 if j == 0 else lam * theta[j])) / m
        rows.append(F.struct(F.lit(j).alias("idx"), ((jp - jm) / F.lit(2 * eps)).alias("numeric"),
                             an.alias("analytic")))
    return wide.select(F.inline(F.array(*rows)))


def _design(df: DataFrame, cols: Sequence[str] | str, target: Column, fold: Column | None = None,
            keep: Sequence[str] = ()) -> DataFrame:
    """(_x array with a leading 1, _y, _f, keep..) of the complete rows, persisted
    (memory, spilling to disk) for the iterations of a fit; a lost executor
    recomputes its blocks from the scan.  ``cols`` are numeric columns or one
    array; _f is the fold, -1 without folds."""
    from pyspark import StorageLevel
    if isinstance(cols, str):
        rows, x = df.filter(complete_vector(cols)), col(cols).cast("array<double>")
    else:
        rows, x = complete(df, cols), F.array(*[col(c).cast("double") for c in cols]) if cols else F.array().cast("array<double>")
    f = F.lit(-1) if fold is None else fold.cast("int")
    return (rows.select(F.concat(F.array(F.lit(1.0)), x).alias("_x"), target.alias("_y"), f.alias("_f"), *keep)
            .filter(F.col("_y").isNotNull() & F.col("_f").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK))


Key = tuple  # (class number, fold left out; -1: none)


def _newton_sums(data: DataFrame, thetas: dict[Key, np.ndarray]) -> dict[Key, tuple[float, float, np.ndarray, np.ndarray]]:
    """(rows, loss, gradient, Hessian) sums of each model (class, fold) against
    target _y = class over the rows outside its fold: numpy products per
    partition over flat Arrow buffers, added by (model, position), so a pass
    sends M (2 + k + k (k + 1) / 2) numbers of each partition and any width and
    any number of folds run the same way."""
    keys = list(thetas)
    k = len(thetas[keys[0]])
    upper = np.triu_indices(k)
    size = 2 + k + len(upper[0])

    def run(batches):
        import pyarrow as pa
        acc, seen = np.zeros((len(keys), size)), False
        for b in batches:
            if not b.num_rows:
                continue
            seen = True
            X = b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            label, fold = b.column("_y").to_numpy(zero_copy_only=False), b.column("_f").to_numpy(zero_copy_only=False)
            for i, (c, f) in enumerate(keys):
                Xf, y = (X, label == c) if f < 0 else (X[fold != f], label[fold != f] == c)
                z = Xf @ thetas[c, f]
                p = np.exp(-np.logaddexp(0.0, -z))
                loss = np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0.0) - y * z
                h = (Xf * (p * (1 - p))[:, None]).T @ Xf
                acc[i] += np.concatenate([[len(z), loss.sum()], Xf.T @ (p - y), h[upper]])
        if seen:
            model, pos = np.divmod(np.arange(acc.size, dtype=np.int32), np.int32(size))
            yield pa.record_batch([pa.array(model), pa.array(pos), pa.array(acc.ravel())], names=["c", "j", "value"])

    rows = (data.select("_x", "_y", "_f").mapInArrow(run, "c int, j int, value double")
            .groupBy("c", "j").agg(F.sum("value").alias("value")).toPandas())
    total = np.zeros((len(keys), size))
    total[rows["c"].to_numpy(), rows["j"].to_numpy()] = rows["value"].to_numpy()
    out = {}
    for key, v in zip(keys, total):
        H = np.zeros((k, k))
        H[upper] = v[2 + k:]
        out[key] = (float(v[0]), float(v[1]), v[2:2 + k], H + np.triu(H, 1).T)
    return out


@dataclass
class LogisticModel:
    theta: np.ndarray
    cost: float
    iterations: int
    history: list = field(default_factory=list)
    converged: bool = False


def _newton(data: DataFrame, start: dict[Key, np.ndarray], lam: float, max_iter: int, tol: float) -> dict[Key, LogisticModel]:
    """Damped Newton for all models at once, one pass per iteration: a step
    that raises the cost is halved; a model is done when its mean gradient is
    below ``tol`` or its cost no longer changes."""
    best = {c: None for c in start}      # (J, theta, full step) of the last accepted point
    trial, models = dict(start), {}
    hist: dict[Key, list] = {c: [] for c in start}
    for it in range(max_iter + 1):
        sums = _newton_sums(data, trial)
        for c, (rows, loss, g, H) in sums.items():
            theta, m = trial[c], max(rows, 1.0)
            reg = np.full(len(theta), lam)
            reg[0] = 0.0
            J = (loss + lam / 2.0 * float(np.sum(theta[1:] ** 2))) / m
            g, H = g + reg * theta, H + np.diag(reg)
            old = best[c]
            if old is not None and J > old[0] + 1e-14 * abs(old[0]):
                step = (theta - old[1]) / 2.0
                if np.max(np.abs(step)) < tol:
                    models[c] = LogisticModel(old[1], old[0], len(hist[c]), hist[c], old[2] < 1e-6)
                    del trial[c]
                else:
                    trial[c] = old[1] + step
                continue
            hist[c].append((len(hist[c]), J))
            gnorm = float(np.max(np.abs(g / m)))
            if gnorm < tol or it == max_iter:
                models[c] = LogisticModel(theta, J, len(hist[c]), hist[c], gnorm < 1e-6)
                del trial[c]
                continue
            best[c] = (J, theta, gnorm)
            trial[c] = theta - np.linalg.lstsq(H, g, rcond=None)[0]
        if not trial:
            break
    for c in trial:
        models[c] = LogisticModel(best[c][1], best[c][0], len(hist[c]), hist[c], False)
    return models


def _width(data: DataFrame) -> int:
    first = data.select(F.size("_x").alias("k")).first()
    if first is None:
        raise ValueError("no complete row to fit")
    return first["k"]


def fit(df: DataFrame, cols: Sequence[str] | str, y: str, lam: float = 0.0, max_iter: int = 25,
        tol: float = 1e-10, theta0: Sequence[float] | None = None) -> LogisticModel:
    """C4: minimise C2 by damped Newton steps over the complete rows; ``cols``
    are numeric columns or the name of one array column of any width.
    ``converged`` says whether the gradient vanished (it doesn't on separable
    data without a penalty)."""
    target = col(y).cast("double")
    data = _design(df, cols, F.when(~F.isnan(target), target).cast("int"))
    try:
        start = np.zeros(_width(data)) if theta0 is None else np.asarray(theta0, dtype=float)
        return _newton(data, {(1, -1): start}, lam, max_iter, tol)[1, -1]
    finally:
        data.unpersist()


@dataclass
class FoldModels:
    """K-fold one-vs-all models (E6): ``thetas[fold][class]`` was trained on the
    rows outside the fold; one model a fold for two classes (of the second)."""
    classes: list
    thetas: dict
    converged: dict
    loss: dict           # fold -> mean log loss of its held-out rows
    rows: dict           # fold -> held-out rows

    def log_loss(self) -> float:
        """Mean over all rows: folds weighted by their rows."""
        n = sum(self.rows.values())
        return sum(self.loss[f] * self.rows[f] for f in self.rows) / n if n else float("nan")


def _class_number(label: str, classes: Sequence) -> Column:
    return F.coalesce(*[F.when(col(label) == F.lit(c), F.lit(i)) for i, c in enumerate(classes)], F.lit(-1))


def _fold_probabilities(thetas: dict, n_classes: int, x: Column) -> Column:
    """array of class probabilities of a row by the models of its own fold _f:
    sigmoids of the K models divided by their sum (two classes: p and 1 - p)."""
    def dot(theta: np.ndarray) -> Column:
        w = F.array(*[F.lit(float(v)) for v in theta])
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)

    out = None
    for f, by in thetas.items():
        if n_classes == 2:
            p1 = sigmoid(dot(by[1]))
            p = F.array(F.lit(1.0) - p1, p1)
        else:
            p = _normalised(F.array(*[sigmoid(dot(by[c])) for c in range(n_classes)]))
        out = F.when(F.col("_f") == f, p) if out is None else out.when(F.col("_f") == f, p)
    return out


def _normalised(p: Column) -> Column:
    total = F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(p, F.array_repeat(total, F.size(p)), lambda a, b: a / b)


def fit_folds(df: DataFrame, cols: Sequence[str] | str, label: str, fold: Column, k: int, lam: float = 0.0,
              classes: Sequence | None = None, max_iter: int = 25, tol: float = 1e-10, keep: Sequence[str] = ()) -> tuple[FoldModels, DataFrame]:
    """E6 for an iterative model: the K one-vs-all logistic fits without each
    fold advance together, one pass per Newton step for all of them.  Returns
    the models and the out-of-fold rows (keep.., fold, label number _y,
    probabilities array p): every complete labelled row, predicted by the models
    that haven't seen its fold.  The rows stay cached until ``unpersist``."""
    classes = list(classes) if classes is not None else distinct_classes(df, label)
    data = _design(df.filter(col(label).isNotNull()), cols, _class_number(label, classes), fold, keep)
    width = _width(data)
    number = [1] if len(classes) == 2 else range(len(classes))
    fitted = _newton(data, {(c, f): np.zeros(width) for f in range(k) for c in number}, lam, max_iter, tol)
    thetas = {f: {c: fitted[c, f].theta for c in number} for f in range(k)}
    p = _fold_probabilities(thetas, len(classes), F.col("_x"))
    oof = data.filter((F.col("_f") >= 0) & (F.col("_f") < k)).select(*keep, F.col("_f").alias("fold"), "_y", p.alias("p"))
    clip = F.least(F.greatest(F.element_at("p", F.col("_y") + 1), F.lit(1e-15)), F.lit(1 - 1e-15))
    per = oof.filter("_y >= 0").groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg(-F.log(clip)).alias("loss")).collect()
    return FoldModels(classes, thetas, {f: all(fitted[c, f].converged for c in number) for f in range(k)},
                      {r["fold"]: r["loss"] for r in per}, {r["fold"]: r["n"] for r in per}), oof


def gd_steps(df: DataFrame, cols: Sequence[str], y: str, alpha: float, steps: int,
             lam: float = 0.0) -> list[tuple[int, float, np.ndarray]]:
    """C4 (fixed-step variant): theta <- theta - alpha * gradient; each step
    is one aggregate returning the gradient and the cost at the current
    theta.  Returns [(iter, J(theta_iter), theta_iter)], iter 0..steps."""
    xs = [F.lit(1.0)] + [col(c).cast("double") for c in cols]
    yy = col(y).cast("double")
    df = complete(df, [*cols, y])
    theta = np.zeros(len(xs))
    out = []
    for it in range(steps + 1):
        z = linear(xs, theta)
        e = sigmoid(z) - yy
        aggs = [F.count(F.lit(1)).alias("m"), F.sum(log_loss_margin(z, yy)).alias("J")]
        aggs += [F.sum(e * x).alias(f"g{j}") for j, x in enumerate(xs)]
        row = df.agg(*aggs).first()
        m = float(row["m"])
        reg = float(np.sum(theta[1:] ** 2))
        out.append((it, (row["J"] + lam * reg / 2.0) / m, theta.copy()))
        if it == steps:
            break
        g = np.array([row[f"g{j}"] for j in range(len(xs))]) / m
        r = lam / m * theta
        r[0] = 0.0
        theta = theta - alpha * (g + r)
    return out


def predict(cols: Sequence[Column | str], theta: Sequence[float], threshold: float = 0.5):
    """(probability, class) with class = p > threshold."""
    p = hypothesis(cols, theta)
    return p, (p > F.lit(threshold)).cast("int")


@dataclass
class OneVsAll:
    classes: list
    thetas: dict  # class -> np.ndarray
    converged: dict = field(default_factory=dict)  # class -> bool


def fit_one_vs_all(df: DataFrame, cols: Sequence[str] | str, label: str, lam: float = 0.0,
                   classes: Sequence | None = None, max_iter: int = 25,
                   tol: float = 1e-10) -> OneVsAll:
    """One binary model per class; every pass computes the sums of all
    classes that haven't converged.  ``cols`` as in :func:`fit`."""
    classes = list(classes) if classes is not None else distinct_classes(df, label)
    data = _design(df.filter(col(label).isNotNull()), cols, _class_number(label, classes))
    try:
        width = _width(data)
        fitted = _newton(data, {(i, -1): np.zeros(width) for i in range(len(classes))}, lam, max_iter, tol)
    finally:
        data.unpersist()
    return OneVsAll(classes, {c: fitted[i, -1].theta for i, c in enumerate(classes)},
                    {c: fitted[i, -1].converged for i, c in enumerate(classes)})


def predict_one_vs_all(model: OneVsAll, cols: Sequence[Column | str]):
    """(class, confidence = 100 * max p); ties go to the first class."""
    ps = [hypothesis(cols, model.thetas[c]) for c in model.classes]
    idx = argmax_index(ps)
    cls = F.element_at(F.array(*[F.lit(c) for c in model.classes]), idx + 1)
    return cls, F.greatest(*ps) * F.lit(100.0) if len(ps) > 1 else ps[0] * F.lit(100.0)


class BinaryClassifier:
    """Polynomial map + logistic fit + accuracy + classify."""

    def __init__(self, cols: Sequence[str], y: str, degree: int | None = None, lam: float = 1.0):
        self.cols, self.y, self.degree, self.lam = list(cols), y, degree, lam
        self.model: LogisticModel | None = None

    def _mapped(self, df: DataFrame, keep=()) -> tuple[DataFrame, list[str]]:
        mcols = polymap_columns(self.cols, self.degree, bias=False, prefix="_m")
        out = df.select(*keep, *mcols)
        return out, [c for c in out.columns if c.startswith("_m")]

    def fit(self, df: DataFrame) -> "BinaryClassifier":
        mapped, names = self._mapped(df, keep=[self.y])
        self.model = fit(mapped, names, self.y, self.lam)
        return self

    def classify(self, df: DataFrame, keep=()) -> DataFrame:
        mapped, names = self._mapped(df, keep=keep)
        p, c = predict(names, self.model.theta)
        return mapped.select(*keep, p.alias("p"), c.alias("pred"),
                             (F.greatest(p, F.lit(1.0) - p) * 100.0).alias("confidence"))

    def accuracy(self, df: DataFrame) -> float:
        scored = self.classify(df, keep=[self.y])
        return float(scored.agg(F.avg((F.col("pred") == F.col(self.y)).cast("double")))
                     .first()[0] * 100.0)
