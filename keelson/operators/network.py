"""Fully connected network with sigmoid units.

Forward passes and back-propagation run as numpy matrix products over
flat Arrow buffers (``mapInArrow``), with the (small) weight matrices shipped
in the task closure.  A cost + gradient evaluation emits, per partition,
one partial row per parameter (plus one for the loss); the partials are
summed by parameter index across the cluster, so the only thing that
reaches the driver is a vector the size of the model.  Training is
L-BFGS on the driver over those distributed evaluations.  Any number of
networks (prefixes of the rows, penalties, step lengths of a line search)
are evaluated in one pass.  Rows whose vector is null or holds a null or NaN,
or whose label is null, take no part in costs, gradients and training."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete_vector

Weights = list[np.ndarray]  # layer l: (L_out, 1 + L_in), column 0 = bias


def init_fixed(fan_out: int, fan_in: int) -> np.ndarray:
    """N1 (deterministic): sin(1..n)/10 laid out column by column."""
    n = fan_out * (1 + fan_in)
    return (np.sin(np.arange(1, n + 1)) / 10.0).reshape((1 + fan_in, fan_out)).T


def init_random(fan_out: int, fan_in: int, epsilon: float = 0.12, seed: int = 0) -> np.ndarray:
    """Uniform in [-epsilon, epsilon]."""
    rng = np.random.default_rng(seed)
    return rng.uniform(-epsilon, epsilon, size=(fan_out, 1 + fan_in))


def _sig(z):
    return 1.0 / (1.0 + np.exp(-z))


def forward_np(X: np.ndarray, W: Weights, hidden: str = "sigmoid"):
    """N3 on one batch: activations of every layer (with bias columns for
    the inputs of each layer) and the pre-activations."""
    acts, zs = [X], []
    a = X
    for li, Wl in enumerate(W):
        a1 = np.hstack([np.ones((a.shape[0], 1)), a])
        z = a1 @ Wl.T
        zs.append(z)
        last = li == len(W) - 1
        a = np.tanh(z) if (hidden == "tanh" and not last) else _sig(z)
        acts.append(a)
    return acts, zs


def _flatten(W: Weights) -> np.ndarray:
    return np.concatenate([w.ravel() for w in W])


def _unflatten(v: np.ndarray, shapes) -> Weights:
    out, i = [], 0
    for s in shapes:
        n = s[0] * s[1]
        out.append(v[i:i + n].reshape(s))
        i += n
    return out


def loss_np(X: np.ndarray, Y: np.ndarray, W: Weights, hidden: str = "sigmoid") -> float:
    """Sum over the batch of the K binary cross-entropies."""
    z = forward_np(X, W, hidden)[1][-1]
    return float(np.sum(np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - Y * z))


def loss_grad_np(X: np.ndarray, Y: np.ndarray, W: Weights, hidden: str = "sigmoid"):
    """Sum over the batch of the K binary cross-entropies and its gradient
    (back-propagation), unregularised and not yet divided by m."""
    acts, zs = forward_np(X, W, hidden)
    zL = zs[-1]
    loss = float(np.sum(np.log1p(np.exp(-np.abs(zL))) + np.maximum(zL, 0) - Y * zL))
    delta = acts[-1] - Y
    grads = [None] * len(W)
    for li in range(len(W) - 1, -1, -1):
        a_in = np.hstack([np.ones((acts[li].shape[0], 1)), acts[li]])
        grads[li] = delta.T @ a_in
        if li > 0:
            back = delta @ W[li][:, 1:]
            a = acts[li]
            deriv = (1.0 - a * a) if hidden == "tanh" else a * (1.0 - a)
            delta = back * deriv
    return loss, grads


def _one_hot(labels: np.ndarray, classes: Sequence) -> np.ndarray:
    """Rows x classes; a label that is none of them has a row of zeros."""
    return (np.asarray(labels)[:, None] == np.asarray(classes)[None, :]).astype(float)


def _class_index(label: str, classes: Sequence) -> Column:
    """0-based class number; -1 for a label that is none of them."""
    return F.coalesce(*[F.when(col(label) == F.lit(c), F.lit(i)) for i, c in enumerate(classes)], F.lit(-1))


def training_rows(df: DataFrame, features: str, label: str, classes: Sequence, rank: str | None = None) -> DataFrame:
    """(_x, _y class number, _r) of the usable rows; ``rank`` is a column with
    the rows' order (from 1), for networks trained on a prefix."""
    return (df.filter(complete_vector(features) & col(label).isNotNull())
            .select(col(features).cast("array<double>").alias("_x"), _class_index(label, classes).alias("_y"),
                    (F.lit(0) if rank is None else col(rank)).cast("long").alias("_r")))


@dataclass
class Trial:
    """One evaluation in a pass: weights, penalty, the prefix of rows that
    counts (None: all), and whether the gradient is wanted."""
    W: Weights
    lam: float = 0.0
    size: int | None = None
    gradient: bool = True


def evaluate_many(rows: DataFrame, trials: Sequence[Trial], n_classes: int,
                  hidden: str = "sigmoid") -> list[tuple[float, np.ndarray | None, int]]:
    """(J, flat gradient or None, m) of every trial from one distributed pass
    over :func:`training_rows`."""
    shapes = [[w.shape for w in t.W] for t in trials]
    # a trial's numbers: m, loss, then its gradient
    sizes = [2 + (sum(a * b for a, b in sh) if t.gradient else 0) for t, sh in zip(trials, shapes)]
    start = np.concatenate([[0], np.cumsum(sizes)])
    todo = [([w.copy() for w in t.W], t.size, t.gradient) for t in trials]
    width = shapes[0][0][1] - 1

    def partials(batches):
        import pyarrow as pa
        acc, seen = np.zeros(start[-1]), False
        for b in batches:
            if not b.num_rows:
                continue
            seen = True
            X = b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            y, r = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_r"))
            Y = _one_hot(y, range(n_classes))
            for i, (W, size, gradient) in enumerate(todo):
                Xi, Yi = (X, Y) if size is None else (X[r <= size], Y[r <= size])
                if not len(Xi):
                    continue
                at = start[i]
                acc[at] += len(Xi)
                if gradient:
                    loss, g = loss_grad_np(Xi, Yi, W, hidden)
                    acc[at + 2:start[i + 1]] += _flatten(g)
                else:
                    loss = loss_np(Xi, Yi, W, hidden)
                acc[at + 1] += loss
        if seen:
            yield pa.record_batch([pa.array(np.arange(len(acc))), pa.array(acc)], names=["idx", "value"])

    sums = (rows.select("_x", "_y", "_r").mapInArrow(partials, "idx long, value double")
            .groupBy("idx").agg(F.sum("value").alias("value")).collect())
    vec = np.zeros(start[-1])
    for r in sums:
        vec[r["idx"]] = r["value"]
    out = []
    for t, sh, a, z in zip(trials, shapes, start[:-1], start[1:]):
        m = vec[a]
        if not m:
            raise ValueError("no usable row")
        reg = sum(float(np.sum(w[:, 1:] ** 2)) for w in t.W)
        g = None
        if t.gradient:
            g = vec[a + 2:z] / m
            for w, gw in zip(t.W, _unflatten(g, sh)):
                gw[:, 1:] += t.lam / m * w[:, 1:]
        out.append((float(vec[a + 1] / m + t.lam / (2.0 * m) * reg), g, int(m)))
    return out


def cost_and_gradient(df: DataFrame, features: str, label: str, W: Weights, classes: Sequence,
                      lam: float = 0.0, hidden: str = "sigmoid") -> tuple[float, Weights, int]:
    """N5 + N6 as one distributed job.  Returns (J, gradients, m) with
    J = sum CE / m + lam/2m * sum of non-bias weights^2 and
    grad = Delta / m + lam/m * W (bias column excluded)."""
    (J, g, m), = evaluate_many(training_rows(df, features, label, classes), [Trial(W, lam)], len(classes), hidden)
    return J, _unflatten(g, [w.shape for w in W]), m


def forward(df: DataFrame, features: str, W: Weights, keep: Sequence[str],
            hidden: str = "sigmoid", layer: int | None = None) -> DataFrame:
    """Activations of ``layer`` (default: output) as an array column
    ``a``, one Arrow pass; null for a vector that is null or holds a null or
    NaN."""
    Wc = [w.copy() for w in W]
    upto = len(W) if layer is None else layer
    keep = list(keep)
    width = Wc[0].shape[1] - 1

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("_x")
            has = np.asarray(x.is_valid())
            acts, _ = forward_np(x.flatten().to_numpy(zero_copy_only=False).reshape(-1, width), Wc[:upto], hidden)
            a = acts[-1]
            ends = np.concatenate([[0], np.cumsum(has) * a.shape[1]]).astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(ends), pa.array(a.ravel()), mask=pa.array(~has))
            yield pa.record_batch([*[b.column(c) for c in keep], values], names=[*keep, "a"])

    rows = df.select(*keep, F.when(complete_vector(features), col(features).cast("array<double>")).alias("_x"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                       for f in df.select(*keep).schema.fields) + ", a array<double>"
    return rows.mapInArrow(run, schema)


def predict(df: DataFrame, features: str, W: Weights, classes: Sequence, keep: Sequence[str],
            hidden: str = "sigmoid") -> DataFrame:
    """(class, probability) = argmax / max of the outputs (first wins); null
    for a vector without activations."""
    out = forward(df, features, W, keep, hidden)
    best = F.array_max("a")
    idx = F.array_position("a", best)
    cls = F.element_at(F.array(*[F.lit(c) for c in classes]), idx.cast("int"))
    return out.select(*keep, F.when(F.col("a").isNotNull(), cls).alias("pred"), best.alias("prob"))


def weights_table(spark, W: Weights, name: str = "value") -> DataFrame:
    rows = [(li + 1, int(o), int(i), float(w[o, i]))
            for li, w in enumerate(W) for o in range(w.shape[0]) for i in range(w.shape[1])]
    return spark.createDataFrame(rows, f"layer int, out int, in int, {name} double")


@dataclass
class TrainResult:
    weights: Weights
    history: list = field(default_factory=list)  # (iter, J)
    jobs: int = 0


@dataclass
class Spec:
    """One network to train: first weights, penalty, prefix of the rows."""
    W0: Weights
    lam: float = 1.0
    size: int | None = None


class _Descent:
    """L-BFGS state of one network: asks for trials, is told their values."""

    def __init__(self, spec: Spec, memory: int):
        self.spec, self.memory = spec, memory
        self.shapes = [w.shape for w in spec.W0]
        self.x, self.J, self.g = _flatten(spec.W0), None, None
        self.S: list = []
        self.Y: list = []
        self.hist: list = []
        self.done = False

    def trial(self, x: np.ndarray, gradient: bool = True) -> Trial:
        return Trial(_unflatten(x, self.shapes), self.spec.lam, self.spec.size, gradient)

    def direction(self) -> np.ndarray:
        q, alphas = self.g.copy(), []
        for s, y in reversed(list(zip(self.S, self.Y))):
            a = s @ q / (y @ s)
            alphas.append(a)
            q -= a * y
        if self.S:
            q *= (self.S[-1] @ self.Y[-1]) / (self.Y[-1] @ self.Y[-1])
        for (s, y), a in zip(zip(self.S, self.Y), reversed(alphas)):
            q += s * (a - y @ q / (y @ s))
        if self.g @ -q >= 0:
            self.S, self.Y = [], []
            return -self.g
        return -q

    def move(self, xn: np.ndarray, Jn: float, gn: np.ndarray) -> None:
        s, y = xn - self.x, gn - self.g
        if y @ s > 1e-12:
            self.S.append(s)
            self.Y.append(y)
            if len(self.S) > self.memory:
                self.S.pop(0)
                self.Y.pop(0)
        self.x, self.J, self.g = xn, Jn, gn
        self.hist.append((len(self.hist), float(Jn)))
        self.done = float(np.max(np.abs(gn))) < 1e-9


# Step lengths 1, 1/2, 1/4, .. of a line search; the last is taken if none will do.
STEPS = 28


def train_many(rows: DataFrame, specs: Sequence[Spec], n_classes: int, max_iter: int = 20,
               hidden: str = "sigmoid", memory: int = 5) -> list[TrainResult]:
    """N8 for many networks in lockstep over :func:`training_rows`: L-BFGS with
    a backtracking (Armijo) line search.  A pass computes every network's cost
    and gradient at its full step; networks for which that won't do have all
    shorter steps evaluated in one second pass.  So an iteration takes one or two
    jobs, however many networks train and lengths are tried, with the history
    that trying one length after another gives."""
    nets = [_Descent(s, memory) for s in specs]
    jobs = 1
    for net, (J, g, _) in zip(nets, evaluate_many(rows, [n.trial(n.x) for n in nets], n_classes, hidden)):
        net.J, net.g, net.hist = J, g, [(0, float(J))]
    for _ in range(max_iter):
        moving = [(n, n.direction()) for n in nets if not n.done]
        if not moving:
            break
        late = []
        jobs += 1
        for (n, d), (J, g, _) in zip(moving, evaluate_many(rows, [n.trial(n.x + d) for n, d in moving], n_classes, hidden)):
            if J <= n.J + 1e-4 * (n.g @ d):
                n.move(n.x + d, J, g)
            else:
                late.append((n, d))
        if late:
            jobs += 1
            shorter = [0.5 ** k for k in range(1, STEPS)]
            seen = evaluate_many(rows, [n.trial(n.x + t * d) for n, d in late for t in shorter], n_classes, hidden)
            for i, (n, d) in enumerate(late):
                mine, slope = seen[i * len(shorter):(i + 1) * len(shorter)], n.g @ d
                k = next((k for k, t in enumerate(shorter) if mine[k][0] <= n.J + 1e-4 * t * slope), len(shorter) - 1)
                n.move(n.x + shorter[k] * d, *mine[k][:2])
    return [TrainResult(_unflatten(n.x, n.shapes), n.hist, jobs) for n in nets]


def train(df: DataFrame, features: str, label: str, W0: Weights, classes: Sequence,
          lam: float = 1.0, max_iter: int = 20, hidden: str = "sigmoid",
          memory: int = 5) -> TrainResult:
    """N8 for one network; the caller should cache ``df`` (features and labels
    only)."""
    rows = training_rows(df, features, label, classes)
    return train_many(rows, [Spec(W0, lam)], len(classes), max_iter, hidden, memory)[0]


def _ranked(df: DataFrame, features: str, label: str, classes: Sequence, order: Sequence[Column | str]) -> tuple[DataFrame, int]:
    """Training rows numbered in ``order`` (a total order), and their number."""
    from keelson.operators.indexing import global_row_index
    keyed = (df.filter(complete_vector(features) & col(label).isNotNull())
             .select(*[col(o).alias(f"_o{i}") for i, o in enumerate(order)],
                     col(features).cast("array<double>").alias("_x"), _class_index(label, classes).alias("_y")))
    numbered = global_row_index(keyed, [f"_o{i}" for i in range(len(order))], name="_r").select("_x", "_y", "_r")
    return numbered, numbered.count()


def learning_curve(train_df: DataFrame, val: DataFrame, features: str, label: str, W0: Weights, classes: Sequence,
                   order: Sequence[Column | str], sizes: Sequence[int], lam: float = 1.0, max_iter: int = 20,
                   hidden: str = "sigmoid") -> list[tuple[int, float, float]]:
    """E9 for networks: for each size i a network trained on the first i usable
    rows (in ``order``); its cost on them and on ``val``, both with ``lam``.  All
    networks train in the same passes; the last size is all rows."""
    rows, m = _ranked(train_df, features, label, classes, order)
    sizes = sorted({int(s) for s in sizes if 0 < s < m} | ({m} if m else set()))
    if not sizes:
        return []
    nets = train_many(rows, [Spec(W0, lam, s) for s in sizes], len(classes), max_iter, hidden)
    inside = evaluate_many(rows, [Trial(n.weights, lam, s, False) for n, s in zip(nets, sizes)], len(classes), hidden)
    outside = evaluate_many(training_rows(val, features, label, classes),
                            [Trial(n.weights, lam, None, False) for n in nets], len(classes), hidden)
    return [(s, a[0], b[0]) for s, a, b in zip(sizes, inside, outside)]


def lambda_curve(train_df: DataFrame, val: DataFrame, features: str, label: str, W0: Weights, classes: Sequence,
                 lambdas: Sequence[float], max_iter: int = 20, hidden: str = "sigmoid") -> list[tuple[float, float, float]]:
    """E10 for networks: for each penalty a network trained on all rows; its cost
    without penalty on them and on ``val``.  All train in the same passes."""
    rows = training_rows(train_df, features, label, classes)
    nets = train_many(rows, [Spec(W0, float(lam)) for lam in lambdas], len(classes), max_iter, hidden)
    plain = [Trial(n.weights, 0.0, None, False) for n in nets]
    inside = evaluate_many(rows, plain, len(classes), hidden)
    outside = evaluate_many(training_rows(val, features, label, classes), plain, len(classes), hidden)
    return [(float(lam), a[0], b[0]) for lam, a, b in zip(lambdas, inside, outside)]


class NeuralNetwork:
    """Layer sizes, sigmoid (or tanh hidden) units, L2 weight penalty."""

    def __init__(self, layers: Sequence[int], lam: float = 1.0, hidden: str = "sigmoid",
                 seed: int = 0, fixed_init: bool = False):
        self.layers, self.lam, self.hidden = list(layers), lam, hidden
        mk = init_fixed if fixed_init else (lambda o, i: init_random(o, i, seed=seed))
        self.W = [mk(self.layers[i + 1], self.layers[i]) for i in range(len(self.layers) - 1)]
        self.classes: list = []
        self.history: list = []

    def add_layer(self, size: int, position: int = -1) -> "NeuralNetwork":
        self.layers.insert(position if position >= 0 else len(self.layers) - 1, size)
        self.W = [init_random(self.layers[i + 1], self.layers[i]) for i in range(len(self.layers) - 1)]
        return self

    def fit(self, df: DataFrame, features: str, label: str, max_iter: int = 20,
            classes: Sequence | None = None) -> "NeuralNetwork":
        from keelson.operators.features import distinct_classes
        self.classes = list(classes) if classes is not None else distinct_classes(df, label)
        res = train(df, features, label, self.W, self.classes, self.lam, max_iter, self.hidden)
        self.W, self.history = res.weights, res.history
        return self

    def cost(self, df: DataFrame, features: str, label: str) -> float:
        return cost_and_gradient(df, features, label, self.W, self.classes, self.lam, self.hidden)[0]

    def predict(self, df: DataFrame, features: str, keep: Sequence[str]) -> DataFrame:
        return predict(df, features, self.W, self.classes, keep, self.hidden)


def numeric_gradient(f, x: np.ndarray, eps: float = 1e-4) -> np.ndarray:
    """N7 helper for small parameter vectors: central differences."""
    g = np.zeros_like(x)
    for i in range(len(x)):
        e = np.zeros_like(x)
        e[i] = eps
        g[i] = (f(x + e) - f(x - e)) / (2 * eps)
    return g
