"""Least squares by a tall-skinny QR (L4-L6 on hard data).

Raw moments lose digits when a feature lies far off its centre or features
are nearly collinear.  Here every partition reduces its rows [1, x, y] to a
triangular factor, factors are merged in a tree, and coefficients, ridge and
cost come from the last factor; the normal matrix is never formed.  Columns are
shifted by their means first, which only changes the intercept.  Factors of
groups (folds) can be merged in any choice, so refits without a fold cost no
further scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete, complete_vector
from keelson.session import cut_lineage

# Factors that one task merges.
FAN = 64
# Rows reduced at once.
ROWS = 4096


@dataclass
class Factor:
    """R of the shifted rows [1, x - shift, y - y_shift]; ``n`` rows."""
    R: np.ndarray
    n: int
    shift: np.ndarray
    y_shift: float

    def coefficients(self, lam: float = 0.0) -> np.ndarray:
        """theta of min |X theta - y|^2 + lam |theta_1..|^2 (least norm if X has
        no full rank)."""
        k = self.R.shape[1] - 1
        A, b = self.R[:, :k], self.R[:, k]
        if lam:
            A = np.vstack([A, np.sqrt(lam) * np.eye(k)[1:]])
            b = np.concatenate([b, np.zeros(k - 1)])
        theta = np.linalg.lstsq(A, b, rcond=None)[0]
        theta[0] += self.y_shift - theta[1:] @ self.shift
        return theta

    def cost(self, theta: np.ndarray, lam: float = 0.0) -> float:
        """(|X theta - y|^2 + lam |theta_1..|^2) / 2n of any theta."""
        t = np.asarray(theta, float)
        moved = np.concatenate([[t[0] - self.y_shift + t[1:] @ self.shift], t[1:], [-1.0]])
        return float((np.sum((self.R @ moved) ** 2) + lam * np.sum(t[1:] ** 2)) / (2 * self.n)) if self.n else float("nan")


def reduced(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _shifts(rows: DataFrame, width: int) -> tuple[int, np.ndarray]:
    r = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("_z")[i]).alias(f"m{i}") for i in range(width)]).first()
    return r["n"], np.array([r[f"m{i}"] or 0.0 for i in range(width)])


def factors(df: DataFrame, cols: Sequence[Column | str] | str, y: Column | str, group: Column | None = None) -> dict:
    """Factor of each value of ``group`` (key None without one) over the
    complete rows; ``cols`` are numeric columns or one array column.  One pass
    for the means, one for the factors."""
    if isinstance(cols, str):
        rows, x = df.filter(complete_vector(cols)), col(cols).cast("array<double>")
    else:
        rows, x = complete(df, cols), F.array(*[col(c).cast("double") for c in cols])
    rows = complete(rows, [y]).select(F.concat(x, F.array(col(y).cast("double"))).alias("_z"),
                                      (F.lit(0) if group is None else group).alias("_g"))
    first = rows.select(F.size("_z").alias("k")).first()
    if first is None:
        return {}
    width = first["k"]
    _, mean = _shifts(rows, width)
    kind = rows.schema["_g"].dataType.simpleString()

    def partial(batches):
        import pyarrow as pa
        held: dict = {}
        kind = None
        for b in batches:
            kind = b.column("_g").type
            z = b.column("_z").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - mean
            g = np.array(b.column("_g").to_pylist(), dtype=object)
            for key in dict.fromkeys(g.tolist()):
                mine = z if len(set(g.tolist())) == 1 else z[np.array([v == key for v in g])]
                R, n = held.get(key, (np.empty((0, width + 1)), 0))
                for s in range(0, len(mine), ROWS):
                    part = mine[s:s + ROWS]
                    R = reduced(np.vstack([R, np.hstack([np.ones((len(part), 1)), part])]))
                    n += len(part)
                held[key] = (R, n)
        if held:
            yield _packed(held, kind)

    def _packed(held, kind):
        import pyarrow as pa
        return pa.record_batch([pa.array(list(held), kind), pa.array([n for _, n in held.values()], pa.int64()),
                                pa.array([R.ravel().tolist() for R, _ in held.values()], pa.list_(pa.float64()))],
                               names=["_g", "n", "r"])

    def merge(key, table):
        import pyarrow as pa
        R = np.concatenate([np.array(r, float).reshape(-1, width + 1) for r in table["r"].to_pylist()])
        out = {table["_g"][0].as_py(): (reduced(R), sum(table["n"].to_pylist()))}
        one = pa.Table.from_batches([_packed(out, table["_g"].type)])
        return one.append_column("_p", pa.array([key[1].as_py()], pa.int32()))

    schema = f"_g {kind}, n long, r array<double>"
    parts = cut_lineage(rows.mapInArrow(partial, schema).withColumn("_p", F.spark_partition_id()))
    most = parts.agg(F.max("_p")).first()[0] or 0
    while most >= FAN:      # a level of the tree: FAN factors of a group become one
        up = parts.withColumn("_p", F.floor(F.col("_p") / FAN).cast("int"))
        parts, most = cut_lineage(up.groupBy("_g", "_p").applyInArrow(merge, schema + ", _p int")), most // FAN
    last: dict = {}
    for r in parts.collect():        # at most FAN factors a group
        last.setdefault(r["_g"], []).append((np.array(r["r"]).reshape(-1, width + 1), r["n"]))
    return {g if group is not None else None: Factor(reduced(np.vstack([R for R, _ in rs])), sum(n for _, n in rs), mean[:-1], float(mean[-1]))
            for g, rs in last.items()}


def factor(df: DataFrame, cols: Sequence[Column | str] | str, y: Column | str) -> Factor:
    """The factor of all complete rows."""
    found = factors(df, cols, y)
    if not found:
        raise ValueError("no complete row to fit")
    return found[None]


def merged(parts: Sequence[Factor]) -> Factor:
    """The factor of several groups' rows together (same shifts)."""
    return Factor(reduced(np.vstack([p.R for p in parts])), sum(p.n for p in parts), parts[0].shift, parts[0].y_shift)


def without_each(groups: dict) -> dict:
    """For every group the factor of all other groups' rows (folds left out)."""
    return {g: merged([p for h, p in groups.items() if h != g]) for g in groups if len(groups) > 1}
