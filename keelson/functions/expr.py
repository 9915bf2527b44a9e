"""Column-expression builders (JVM side, whole-stage codegen friendly).

Nothing here runs Python per row: every helper returns a
``pyspark.sql.Column`` built from built-in functions, so the same
expression scores a batch frame, a streaming frame or a SQL view.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def col(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(z: ColLike) -> Column:
    """1 / (1 + e^-z)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(z)))


def sigmoid_prime(z: ColLike) -> Column:
    """s(z) * (1 - s(z))."""
    s = sigmoid(z)
    return s * (F.lit(1.0) - s)


def log_loss_margin(z: ColLike, y: ColLike) -> Column:
    """Binary cross-entropy of sigmoid(z) against y, written with the margin
    so it stays finite: ln(1 + e^-|z|) + max(z, 0) - y*z."""
    z = col(z)
    return F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - col(y) * z


def linear(cols: Sequence[ColLike], weights: Sequence[float],
           intercept: float | None = None) -> Column:
    """intercept + sum_j w_j * x_j with the weights inlined as literals."""
    terms = [col(c) * F.lit(float(w)) for c, w in zip(cols, weights)]
    if intercept is not None:
        terms = [F.lit(float(intercept))] + terms
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def array_dot(arr: ColLike, weights: Sequence[float], intercept: float | None = None) -> Column:
    """Dot product of an array column with a literal weight vector.  The
    terms are unrolled, so the expression stays inside generated code."""
    a = col(arr)
    return linear([a[i] for i in range(len(weights))], weights, intercept)


def array_sqdist(arr: ColLike, centre: Sequence[float]) -> Column:
    """Squared Euclidean distance of an array column to a literal point."""
    a = col(arr)
    out = None
    for i, c in enumerate(centre):
        d = a[i] - F.lit(float(c))
        out = d * d if out is None else out + d * d
    return out


def cols_sqdist(cols: Sequence[ColLike], centre: Sequence[float]) -> Column:
    out = None
    for c, m in zip(cols, centre):
        d = col(c) - F.lit(float(m))
        out = d * d if out is None else out + d * d
    return out


def array_sqdist_cols(a: ColLike, b: ColLike) -> Column:
    """Squared distance between two array columns of equal length."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0), lambda acc, v: acc + v)


def rbf(sqdist: Column, sigma: float) -> Column:
    """Gaussian similarity exp(-d^2 / (2 sigma^2))."""
    return F.exp(-sqdist / F.lit(2.0 * sigma * sigma))


def monomial_exponents(n: int, degree: int, bias: bool = True) -> list[tuple[int, ...]]:
    """Exponent tuples of all monomials of total degree <= ``degree`` in
    graded order: 1, x1..xn, then for each degree the
    combinations-with-replacement order (x^2, xy, y^2, ...)."""
    out: list[tuple[int, ...]] = []
    start = 0 if bias else 1
    for d in range(start, degree + 1):
        for combo in itertools.combinations_with_replacement(range(n), d):
            e = [0] * n
            for i in combo:
                e[i] += 1
            out.append(tuple(e))
    return out


def monomial(cols: Sequence[ColLike], exps: Sequence[int]) -> Column:
    term = None
    for c, e in zip(cols, exps):
        for _ in range(e):
            term = col(c) if term is None else term * col(c)
    return F.lit(1.0) if term is None else term


def argmin_index(values: Sequence[Column]) -> Column:
    """0-based index of the smallest value; ties go to the lowest index.
    Linear in the number of values (one array, its minimum, its position)."""
    arr = F.array(*values)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def argmax_index(values: Sequence[Column]) -> Column:
    """0-based index of the largest value; ties go to the lowest index."""
    arr = F.array(*values)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def max_of(values: Sequence[Column]) -> Column:
    return values[0] if len(values) == 1 else F.greatest(*values)


def normal_log_pdf(x: ColLike, mu: float, var: float) -> Column:
    """log N(x; mu, var), var > 0."""
    d = col(x) - F.lit(float(mu))
    return F.lit(-0.5 * math.log(2 * math.pi * var)) - d * d / F.lit(2.0 * var)


def complete(df, cols):
    """Rows in which every listed column is present: not null and, as a number,
    not NaN.  Fits and costs apply it once to X and y, so that all their sums
    run over the same rows."""
    ok = None
    for c in cols:
        x = col(c).cast("double")
        one = x.isNotNull() & ~F.isnan(x)
        ok = one if ok is None else ok & one
    return df if ok is None else df.filter(ok)


def complete_vector(c):
    """True for an array that is not null and holds neither null nor NaN."""
    x = col(c).cast("array<double>")
    return F.coalesce(x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)), F.lit(False))
