"""Support vector machines (V1-V6).

Linear SVM: ``pyspark.ml.classification.LinearSVC`` (distributed OWL-QN over
tree aggregates) with the penalty mapped to the soft-margin constant:
regParam = 1 / (C m), no standardisation.  The kernel (RBF) SVM is
re-aimed as a Nystrom feature map: with K the landmarks' kernel matrix
(a model of bounded size, never an m x m matrix), k(x) K^(-1/2) are features
whose products approximate the kernel, so the linear fit's norm is the kernel
norm; with all rows as landmarks the fit is the kernel machine itself.
Prediction is a literal expression (batch or stream)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import array_dot, array_sqdist, complete, complete_vector, rbf

def linear_score(features: str, w: Sequence[float], b: float) -> Column:
    """V3 (linear): x . w + b."""
    return array_dot(features, w, intercept=b)


def similarities(features: str, landmarks: np.ndarray, sigma: float) -> list[Column]:
    """Gaussian similarity of each row to every landmark."""
    return [rbf(array_sqdist(features, c), sigma) for c in landmarks]


def nystrom_map(landmarks: np.ndarray, sigma: float, tol: float = 1e-10) -> np.ndarray:
    """M (landmarks x r) with M M' = K^+: similarities times M are features
    whose inner products are the kernel on the landmarks.  Directions with less
    than ``tol`` of the largest eigenvalue (repeated landmarks) are left out."""
    L = np.asarray(landmarks, dtype=float)
    d2 = ((L[:, None, :] - L[None]) ** 2).sum(axis=2)
    S, U = np.linalg.eigh(np.exp(-d2 / (2.0 * sigma * sigma)))
    on = S > tol * S[-1]
    return U[:, on] / np.sqrt(S[on])


# Rows that a task computes on at a time.
SLICE = 2000


def kernel_values(vectors: pa.Array, landmarks: np.ndarray, sigmas: Sequence[float],
                  maps: Sequence[np.ndarray | None]) -> pa.Array:
    """For every vector the similarities of each sigma in turn (times its matrix),
    as one list; null for a null vector."""
    ok = np.asarray(vectors.is_valid())
    some = vectors.drop_null()
    widths = [len(landmarks) if M is None else M.shape[1] for M in maps]
    out = np.empty((len(some), sum(widths)))
    if len(some):
        X = some.flatten().to_numpy(zero_copy_only=False)
        dims = landmarks.shape[1] if len(landmarks) else len(X) // len(some)
        if (np.diff(np.asarray(some.offsets)) != dims).any():
            raise ValueError(f"a vector hasn't {dims} components")
        X = X.reshape(-1, dims)
        for a in range(0, len(X), SLICE):
            x = X[a:a + SLICE]
            d2 = np.empty((len(x), len(landmarks)))
            for j, c in enumerate(landmarks):
                d = x - c
                d2[:, j] = np.einsum("ij,ij->i", d, d)
            at = 0
            for s, M, w in zip(sigmas, maps, widths):
                S = np.exp(-d2 / (2.0 * s * s))
                out[a:a + len(x), at:at + w] = S if M is None else S @ M
                at += w
    ends = np.concatenate([[0], np.cumsum(ok * out.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()), mask=pa.array(~ok))


def _features(df: DataFrame, features: str, landmarks: np.ndarray, sigmas: Sequence[float],
              maps: Sequence[np.ndarray | None], out: str) -> DataFrame:
    L = np.asarray(landmarks, dtype=float)

    @F.arrow_udf("array<double>")
    def run(vectors: pa.Array) -> pa.Array:
        return kernel_values(vectors, L, sigmas, maps)

    return df.withColumn(out, run(F.when(complete_vector(features), F.col(features).cast("array<double>"))))


def similarity_features(df: DataFrame, features: str, landmarks: np.ndarray, sigma: float,
                        out: str = "sims", mixed: np.ndarray | None = None) -> DataFrame:
    """V4 as an array column ``out`` (one entry per landmark, any number of
    landmarks, numpy over Arrow batches), or times the matrix ``mixed`` (see
    :func:`nystrom_map`); null for a row without a complete vector."""
    return _features(df, features, landmarks, [sigma], [mixed], out)


def row_landmarks(df: DataFrame, features: str, key: str, n: int = 64, seed: int = 17) -> np.ndarray:
    """``n`` landmarks: the vectors of a seeded sample of rows (a top-n by a
    hash of the key)."""
    rows = (df.filter(complete_vector(features)).orderBy(F.xxhash64(F.col(key), F.lit(seed)), key)
            .select(features).limit(n).collect())
    return np.array([list(r[0]) for r in rows], dtype=float)


def rbf_score(features: str, landmarks: np.ndarray, coef: Sequence[float], b: float,
              sigma: float) -> Column:
    """V3 (kernel): sum_l alpha_l y_l K(x, s_l) + b."""
    out = F.lit(float(b))
    for s, a in zip(similarities(features, landmarks, sigma), coef):
        out = out + s * F.lit(float(a))
    return out


def classify(score: Column) -> Column:
    """class 1 when the score is >= 0."""
    return (score >= 0).cast("int")


def class_means(df: DataFrame, features: str, label: str, dims: int) -> tuple[list, np.ndarray]:
    """Landmarks from data: the mean vector of every class (one grouped
    aggregate with ``dims`` averages; rows = number of classes)."""
    x = F.col(features)
    rows = (df.groupBy(label).agg(*[F.avg(x[i]).alias(f"m{i}") for i in range(dims)])
            .orderBy(label).collect())
    return [r[label] for r in rows], np.array([[r[f"m{i}"] for i in range(dims)] for r in rows])


def fit_linear(df: DataFrame, features: Sequence[Column] | str, label: str, C: float = 1.0,
               max_iter: int = 200, dims: int | None = None, tol: float = 1e-6):
    """V1: soft-margin linear SVM; returns (w, b)."""
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import array_to_vector
    if isinstance(features, str):
        vec = array_to_vector(F.col(features))
    else:
        vec = array_to_vector(F.array(*features))
    if isinstance(features, str):
        df = df.filter(complete_vector(features))
    else:
        df = complete(df, features)
    data = df.filter(F.col(label).isNotNull()).select(
        vec.alias("features"), F.col(label).cast("double").alias("label")).persist()
    try:
        m = data.count()
        svc = LinearSVC(regParam=1.0 / (C * m), standardization=False, maxIter=max_iter,
                        fitIntercept=True, tol=tol)
        model = svc.fit(data)
    finally:
        data.unpersist()
    return np.array(model.coefficients.toArray()), float(model.intercept)


# Half-widths of the quadratic part that stands for the hinge's corner, in turn.
CORNERS = (2.0, 0.3, 0.05, 0.008)


@dataclass
class Machine:
    """One machine to train: its penalty, and its features' place in the rows."""
    C: float
    start: int
    width: int


def _hinge_sums(rows: DataFrame, trials: Sequence[tuple[Machine, np.ndarray]], corner: float) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(loss, gradient, Hessian) sums of the smoothed hinge of every machine over
    rows (_x, _y of -1 or 1), in one pass."""
    uppers = [np.triu_indices(m.width + 1) for m, _ in trials]
    ends = np.cumsum([0] + [1 + m.width + 1 + len(u[0]) for (m, _), u in zip(trials, uppers)])

    def run(batches):
        acc, seen = np.zeros(ends[-1]), False
        for b in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            seen = True
            every = b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            y = b.column("_y").to_numpy(zero_copy_only=False)
            for (m, theta), upper, a, z in zip(trials, uppers, ends[:-1], ends[1:]):
                X = np.hstack([np.ones((len(y), 1)), every[:, m.start:m.start + m.width]])
                s = 1.0 - y * (X @ theta)
                near = np.abs(s) < corner
                loss = np.where(near, (s + corner) ** 2 / (4 * corner), np.maximum(s, 0.0))
                slope = np.clip((s + corner) / (2 * corner), 0.0, 1.0)
                acc[a:z] += np.concatenate([[loss.sum()], -X.T @ (slope * y), (X[near].T @ X[near] / (2 * corner))[upper]])
        if seen:
            yield pa.record_batch([pa.array(np.arange(len(acc))), pa.array(acc)], names=["j", "value"])

    got = (rows.select("_x", "_y").mapInArrow(run, "j long, value double")
           .groupBy("j").agg(F.sum("value").alias("value")).toPandas())
    total = np.zeros(ends[-1])
    total[got["j"].to_numpy()] = got["value"].to_numpy()
    out = []
    for (m, _), upper, a, z in zip(trials, uppers, ends[:-1], ends[1:]):
        k, v = m.width + 1, total[a:z]
        H = np.zeros((k, k))
        H[upper] = v[1 + k:]
        out.append((float(v[0]), v[1:1 + k], H + np.triu(H, 1).T))
    return out


def hinge_newton(rows: DataFrame, machines: Sequence[Machine], corners: Sequence[float] = CORNERS, max_iter: int = 30,
                 tol: float = 1e-5) -> list[tuple[np.ndarray, float]]:
    """(w, b) of every machine, minimising 1/2 |w|^2 + C sum hinge over rows
    (_x, _y): damped Newton steps on a hinge whose corner is rounded less and
    less (so the cost is within C m / 4 of the last corner's width); the damping
    grows tenfold after a step that raises the cost.  All machines advance in
    the same passes; at each corner one stops when its cost falls by less than
    ``tol`` of itself."""
    theta = [np.zeros(m.width + 1) for m in machines]
    free = [np.concatenate([[0.0], np.ones(m.width)]) for m in machines]
    for corner in corners:
        held: dict = {}                     # number -> (J, theta, gradient, Hessian) of the last accepted point
        damp = dict.fromkeys(range(len(machines)), 1e-4)
        trial = dict(enumerate(theta))
        for _ in range(max_iter):
            if not trial:
                break
            todo = list(trial.items())
            for (i, t), (loss, g, H) in zip(todo, _hinge_sums(rows, [(machines[i], t) for i, t in todo], corner)):
                C = machines[i].C
                J = 0.5 * float(np.sum(t[1:] ** 2)) + C * loss
                old = held.get(i)
                if old is None or J < old[0]:
                    theta[i] = t
                    held[i] = (J, t, free[i] * t + C * g, np.diag(free[i]) + C * H)
                    if old is not None and old[0] - J <= tol * abs(J):
                        del trial[i]
                        continue
                    damp[i] = max(damp[i] / 10, 1e-9)
                else:
                    damp[i] *= 10
                    if damp[i] > 1e6:
                        del trial[i]
                        continue
                _, t, g, H = held[i]
                trial[i] = t - np.linalg.solve(H + damp[i] * (1.0 + np.trace(H) / len(t)) * np.eye(len(t)), g)
    return [(t[1:], float(t[0])) for t in theta]


def _kernel_rows(df: DataFrame, features: str, label: str, landmarks: np.ndarray, sigmas: Sequence[float],
                 maps: Sequence[np.ndarray]) -> DataFrame:
    """(_x, _y) of the usable rows: the kernel features of every sigma in turn."""
    # a filter of the features themselves would compute them twice
    usable = df.filter(F.col(label).isNotNull() & complete_vector(features)).select(features, label)
    return _features(usable, features, landmarks, sigmas, maps, "_x").select(
        "_x", F.when(F.col(label) > 0, 1.0).otherwise(-1.0).alias("_y"))


def _held(rows: DataFrame) -> DataFrame:
    """``rows``, cached before their first pass, so that a task needs one Python
    worker at a time."""
    rows = rows.persist()
    rows.count()
    return rows


def fit_rbf(df: DataFrame, features: str, label: str, landmarks: np.ndarray, sigma: float,
            C: float = 1.0, max_iter: int = 30):
    """V2: soft-margin machine with the Gaussian kernel restricted to the
    landmarks' span: minimises 1/2 |f|^2 + C sum hinge with |f| the kernel norm.
    Returns (a, b) of f(x) = sum_l a_l K(x, s_l) + b (see :func:`rbf_score`).
    Features are computed once and cached for the Newton passes."""
    M = nystrom_map(landmarks, sigma)
    rows = _held(_kernel_rows(df, features, label, landmarks, [sigma], [M]))
    try:
        (w, b), = hinge_newton(rows, [Machine(float(C), 0, M.shape[1])], max_iter=max_iter)
    finally:
        rows.unpersist()
    return M @ w, b


def kernel_objective(df: DataFrame, features: str, label: str, landmarks: np.ndarray, coef: np.ndarray, b: float,
                     sigma: float, C: float) -> float:
    """1/2 a' K a + C sum max(0, 1 - y f(x)) over the usable rows."""
    L = np.asarray(landmarks, dtype=float)
    K = np.exp(-((L[:, None, :] - L[None]) ** 2).sum(axis=2) / (2.0 * sigma * sigma))
    rows = similarity_features(df.filter(F.col(label).isNotNull()).select(features, label), features, L, sigma,
                               mixed=np.asarray(coef, float)[:, None]).filter(F.col("sims").isNotNull())
    y = F.when(F.col(label) > 0, 1.0).otherwise(-1.0)
    hinge = rows.agg(F.sum(F.greatest(F.lit(0.0), 1.0 - y * (F.col("sims")[0] + F.lit(float(b)))))).first()[0] or 0.0
    return float(0.5 * coef @ K @ coef + C * hinge)


def grid_search(train: DataFrame, val: DataFrame, features: str, label: str,
                landmarks: np.ndarray, Cs: Sequence[float], sigmas: Sequence[float]):
    """V5: validation error for every (C, sigma); returns rows sorted by
    error then C then sigma (the first is the choice).  Without a usable
    validation row every error is infinite.

    The kernel features of all sigmas are computed once and all machines train in
    the same passes (to a rounder corner and fewer steps than :func:`fit_rbf`);
    one pass scores them."""
    maps = [nystrom_map(landmarks, s) for s in sigmas]
    starts = np.cumsum([0] + [M.shape[1] for M in maps])
    machines = [Machine(float(C), int(a), M.shape[1]) for a, M in zip(starts, maps) for C in Cs]
    tr, va = (_kernel_rows(d, features, label, landmarks, sigmas, maps) for d in (train, val))
    tr = _held(tr)
    try:
        fits = hinge_newton(tr, machines, CORNERS[:3], 10, 1e-4)
    finally:
        tr.unpersist()
    x = F.col("_x")
    wrong = []
    for i, (m, (w, b)) in enumerate(zip(machines, fits)):
        dot = F.aggregate(F.zip_with(F.slice(x, m.start + 1, m.width), F.array(*[F.lit(float(v)) for v in w]), lambda p, q: p * q),
                          F.lit(float(b)), lambda acc, v: acc + v)
        wrong.append(F.avg(((dot >= 0) != (F.col("_y") > 0)).cast("double")).alias(f"e{i}"))
    err = va.agg(*wrong).first()
    keys = [(float(C), float(s)) for s in sigmas for C in Cs]
    return sorted([(*k, float("inf") if err[i] is None else float(err[i])) for i, k in enumerate(keys)], key=lambda t: (t[2], t[0], t[1]))
