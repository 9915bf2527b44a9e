"""Principal components.

The (uncentred) second-moment matrix X'X/m of the normalised features is a
Gram scan (narrow: one aggregate; wide arrays: Arrow partial products
summed by (i, j) key).  The n x n eigen-decomposition runs on the driver;
projection and reconstruction are literal dot products (narrow stage), or numpy
products for array features.  For wide or sparse features block subspace
iteration finds the leading directions from products X'(XQ), without any n x n
matrix; for sparse ones Q is a table by term."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete_vector, linear
from keelson.operators import gram as G
from keelson.operators import many_sparse as MS
from keelson.operators.joins import join_skewed
from keelson.operators.lookup import parted
from keelson.session import cut_lineage, cut_partitioned, release


def covariance(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """D1 for named columns: X'X / m (uncentred; normalise first)."""
    Gm = G.gram(df, cols, None, intercept=True)
    return Gm[1:, 1:] / Gm[0, 0]


def covariance_long(df: DataFrame, features: str, dims: int, mu=None, sd=None) -> DataFrame:
    """D1 for an array column: (i, j, value) i <= j of X'X/m over the complete
    vectors, with optional normalisation applied inside the partial products."""
    return G.gram_long(df, features, dims, mu, sd, with_count=True).select("i", "j", (F.col("value") / F.col("n")).alias("value"))


def fix_signs(U: np.ndarray, tol: float = 1e-12) -> np.ndarray:
    """Make the first non-zero entry of every component positive."""
    U = U.copy()
    for k in range(U.shape[1]):
        for v in U[:, k]:
            if abs(v) > tol:
                if v < 0:
                    U[:, k] = -U[:, k]
                break
    return U


@dataclass
class PCAModel:
    U: np.ndarray  # columns = principal directions
    S: np.ndarray  # eigenvalues, descending

    def retained(self) -> list[float]:
        """D3: 100 * cumulative share of the eigenvalues."""
        c = np.cumsum(self.S)
        return list(100.0 * c / c[-1])

    def min_components(self, confidence: float = 95.0) -> int:
        """First k retaining >= confidence percent (capped at n)."""
        for k, r in enumerate(self.retained(), start=1):
            if r >= confidence - 1e-12:
                return k
        return len(self.S)


def directions(cov: np.ndarray) -> PCAModel:
    """Eigen-decomposition of the symmetric covariance (= its SVD)."""
    S, U = np.linalg.eigh(cov)
    order = np.argsort(-S, kind="stable")
    return PCAModel(fix_signs(U[:, order]), S[order])


def project(cols: Sequence[Column | str], model: PCAModel, k: int) -> list[Column]:
    """z_c = x . U[:, c] for c < k."""
    return [linear(cols, model.U[:, c]) for c in range(k)]


def reconstruct(zs: Sequence[Column | str], model: PCAModel) -> list[Column]:
    """x_rec = Z U[:, :k]'."""
    k = len(zs)
    return [linear(zs, model.U[j, :k]) for j in range(model.U.shape[0])]


def cost(df: DataFrame, cols: Sequence[str], model: PCAModel, k: int) -> DataFrame:
    """Mean squared norm of x - x_rec."""
    zs = project(cols, model, k)
    rec = reconstruct(zs, model)
    sq = None
    for c, rcol in zip(cols, rec):
        d = col(c) - rcol
        sq = d * d if sq is None else sq + d * d
    return df.agg(F.avg(sq).alias("cost"))


# ---- array features --------------------------------------------------------------
def _times(df: DataFrame, features: str, matrix: np.ndarray, out: str) -> DataFrame:
    """``df`` with the array column features . matrix; null for a vector that
    isn't complete."""
    M = np.asarray(matrix, dtype=float)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            x = b.column("_x")
            has = np.asarray(x.is_valid())
            z = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, M.shape[0]) @ M
            ends = np.concatenate([[0], np.cumsum(has) * M.shape[1]]).astype(np.int32)
            array = pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()), mask=pa.array(~has))
            yield pa.record_batch([*b.columns[:-1], array], names=[*b.schema.names[:-1], out])

    kept = df.drop(out) if out != features else df.drop(features)
    rows = df.select(*[F.col(f"`{c}`") for c in kept.columns],
                     F.when(complete_vector(features), col(features).cast("array<double>")).alias("_x"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return rows.mapInArrow(run, f"{schema}, `{out}` array<double>")


def project_array(df: DataFrame, features: str, model: PCAModel, k: int, out: str = "z") -> DataFrame:
    """D5 for an array column: z = x U[:, :k], one Arrow pass."""
    return _times(df, features, model.U[:, :k], out)


def reconstruct_array(df: DataFrame, z: str, model: PCAModel, k: int, out: str = "x_rec") -> DataFrame:
    """D6 for an array column: x_rec = z U[:, :k]'."""
    return _times(df, z, model.U[:, :k].T, out)


def start_block(n: int, k: int, seed: int = 5) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((n, k)))[0]


def subspace(df: DataFrame, features: str, k: int, iters: int = 30, extra: int = 8, tol: float = 1e-10, seed: int = 5) -> PCAModel:
    """D2 for wide array features: the ``k`` leading directions and eigenvalues
    of X'X / m over the complete vectors, by block subspace iteration with
    ``extra`` more columns.  A pass sums X'(XQ) by position: n (k + extra)
    numbers reach the driver, never n x n.  Ends when the eigenvalues change by
    less than ``tol`` of the largest."""
    from pyspark import StorageLevel
    rows = df.filter(complete_vector(features)).select(col(features).cast("array<double>").alias("x")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = rows.select(F.size("x").alias("n")).first()
        if first is None:
            raise ValueError("no complete vector")
        n, m = first["n"], rows.count()
        width = min(n, k + extra)
        Q, last = start_block(n, width, seed), None

        def product(Q: np.ndarray) -> np.ndarray:
            def run(batches):
                import pyarrow as pa
                acc, seen = np.zeros_like(Q), False
                for b in batches:
                    if b.num_rows:
                        x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
                        acc += x.T @ (x @ Q)
                        seen = True
                if seen:
                    yield pa.record_batch([pa.array(np.arange(acc.size)), pa.array(acc.ravel())], names=["i", "v"])
            sums = rows.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
            out = np.zeros(Q.size)
            out[sums["i"].to_numpy()] = sums["v"].to_numpy()
            return out.reshape(Q.shape)

        for _ in range(iters):
            Y = product(Q)
            S, V = np.linalg.eigh((Q.T @ Y + Y.T @ Q) / 2)      # Rayleigh quotient of this block
            S, V = S[::-1], V[:, ::-1]
            done = last is not None and np.max(np.abs(S[:k] - last[:k])) <= tol * max(S[0], 1e-300)
            Q, last = np.linalg.qr(Y @ V)[0], S
            if done:
                break
        S, V = np.linalg.eigh(_symmetric(Q, product(Q)))
        U = (Q @ V[:, ::-1])[:, :k]
        return PCAModel(fix_signs(U), S[::-1][:k] / m)
    finally:
        rows.unpersist()


def _symmetric(Q: np.ndarray, Y: np.ndarray) -> np.ndarray:
    B = Q.T @ Y
    return (B + B.T) / 2


@dataclass
class SparseComponents:
    """Leading directions of a sparse table: ``directions`` (term, u array) and
    eigenvalues of X'X / m."""
    directions: DataFrame
    S: np.ndarray

    def table(self) -> DataFrame:
        """(component, term, weight), components from 0."""
        return self.directions.select(F.posexplode("u").alias("component", "weight"), "term").select("component", "term", "weight")

    def project(self, rows: DataFrame, id_col: str = "doc_id", term: str = "term", x: str = "w") -> DataFrame:
        """(id, component, z): D5 on (id, term, x) rows; terms without a direction
        add nothing.  Sums by id are combined before their shuffle."""
        k = len(self.S)
        met = join_skewed(rows.select(F.col(id_col), F.col(term).alias("term"), F.col(x).alias("x")), self.directions, ["term"], "inner")
        z = met.groupBy(id_col).agg(*[F.sum(F.col("x") * F.col("u")[i]).alias(f"z{i}") for i in range(k)])
        return z.select(id_col, F.posexplode(F.array(*[F.col(f"z{i}") for i in range(k)])).alias("component", "z"))


def sparse_subspace(rows: DataFrame, k: int, iters: int = 20, extra: int = 4, tol: float = 1e-10, id_col: str = "doc_id",
                    term: str = "term", x: str = "w", seed: int = 5, entries: int | None = None) -> SparseComponents:
    """D2 on (id, term, x) rows, or (id, terms, x) lists with about ``entries``
    entries, uncentred, for any vocabulary: block subspace iteration.  Entries are
    dealt to blocks of terms once (:func:`many_sparse.post`).  Only Z = XQ, by
    document, is kept from pass to pass: a block gets Z, forms its terms' rows of
    W = X'Z and sends back its share of XW; no table by term is written before the
    end.  Q = WT is orthonormal for a small T from W'W, so that the next Z is XWT,
    and Z'Z gives eigenvalues; only these matrices, of (k + extra)^2 numbers, reach
    the driver.  Eigenvalues are of X'X / m, m the number of ids; ids and terms
    must not be null."""
    listed = "terms" in rows.columns
    rows = rows.select(F.col(id_col).alias("id"), "terms" if listed else F.col(term).alias("term"),
                       F.col(x).cast("array<double>" if listed else "double").alias("n"))
    posted = MS.post(rows, None, "id", entries)
    sizes, tasks = posted.sizes, rows.sparkSession.sparkContext.defaultParallelism

    def counted(batches):
        import pyarrow as pa
        for s in MS.Block(batches, sizes).slices():
            yield pa.record_batch([pa.array([len(s.terms)], pa.int64())], names=["n"])

    m, n = sum(sizes.values()), posted.posts.mapInArrow(counted, "n long").agg(F.sum("n")).first()[0]
    if not m or not n:
        raise ValueError("no rows")
    k, width = min(k, n), min(k + extra, n)

    def noisy(i: int) -> Column:
        return F.transform(parted(), lambda t: F.hash(t, F.lit(seed + i)) / F.lit(2.0 ** 31)).alias(f"q{i}")

    noise = [noisy(i) for i in range(width)]
    list_of = MS.list_of

    def weighed(b: MS.Block):
        """Slices of terms and their rows of W: X'Z, or the noise that it starts from."""
        for s in b.slices():
            if b.take is None:
                q = np.stack([MS.lists(s.rows[f"q{i}"], np.float64)[0] for i in range(width)], axis=1)
                yield s, q[np.unique(s.code, return_index=True)[1]]
            else:
                yield s, np.stack([np.bincount(s.term, s.n * z[s.doc], len(s.terms)) for z in b.z], axis=1)

    def shares(b: MS.Block):
        """A task's share of XW by part, and of W'W as part -1."""
        import pyarrow as pa
        out, both = np.zeros((width, b.m)), np.zeros((width, width))
        for s, w in weighed(b):
            both += w.T @ w
            for i in range(width):
                out[i] += np.bincount(s.doc, s.n * w[s.term, i], b.m)
        if b.seen:
            yield from b.by_part(out).to_batches()
            yield from pa.table({"part": pa.array([-1], pa.int32()), "v": pa.array([both.tobytes()], pa.binary())}).to_batches()

    def told(b: MS.Block, M: np.ndarray):
        """(term, u = w M)."""
        import pyarrow as pa
        for s, w in weighed(b):
            yield from pa.table({"term": s.terms, "u": list_of(w @ M)}).to_batches()

    def passed(state, body, schema: str):
        """``body`` over the blocks, with Z = v T of ``state`` (v by part, T), or the noise."""
        if state is None:
            begun = posted.posts.select("*", *noise)
            begun = begun.coalesce(tasks) if tasks < len(posted.blocks) else begun
            return begun.mapInArrow(lambda batches: body(MS.Block(batches, sizes)), schema)
        frame, T = state

        def sent(batches):
            import pyarrow as pa
            for b in batches:
                for p, v in zip(b.column("part").to_pylist(), b.column("v")):
                    z = T.T @ np.frombuffer(v.as_buffer(), np.float64).reshape(width, -1)
                    yield pa.record_batch([pa.array([p], pa.int32()), pa.array([z.tobytes()], pa.binary())], names=["part", "v"])

        docs = frame.filter("part >= 0").select("part", "v").mapInArrow(sent, "part int, v binary")
        return MS.streamed(posted, docs, lambda batches: body(Vectors(batches, sizes, width)), schema, tasks)

    def total(key, t):
        """The sum of the shares of a part, v, and v'v (of part -1: that sum itself)."""
        import pyarrow as pa
        part = key[0].as_py()
        v = MS.added(t, width, width if part < 0 else sizes[part])
        return pa.table({"part": pa.array([part], pa.int32()), "v": pa.array([v.tobytes()], pa.binary()),
                         "both": list_of((v if part < 0 else v @ v.T).reshape(1, -1))})

    def product(state):
        """XW by part, written, its Gram matrix and that of W."""
        summed = passed(state, shares, "part int, v binary").groupBy("part").applyInArrow(total, "part int, v binary, both array<double>")
        frame = cut_partitioned(summed, len(posted.blocks), "part")
        ZZ, WW = np.zeros((width, width)), np.zeros((width, width))
        for r in frame.select("part", "both").toLocalIterator():
            (WW if r["part"] < 0 else ZZ)[...] += np.array(r["both"]).reshape(width, width)
        return frame, ZZ, WW

    def orthonormal(V: np.ndarray, C: np.ndarray) -> np.ndarray:
        """T with Y T orthonormal, Y'Y = C: columns turned by V, scaled, then
        made orthonormal without a change of order."""
        Z = V.T @ C @ V
        d = 1.0 / np.sqrt(np.maximum(np.diag(Z), 1e-300))
        e, U = np.linalg.eigh(Z * d[:, None] * d[None, :])
        return (V * d) @ (U / np.sqrt(np.maximum(e, 1e-14))) @ U.T

    state, (frame, ZZ, WW) = None, product(None)       # W is made from state, frame is XW
    T, last, V, S = orthonormal(np.eye(width), WW), None, np.eye(width), np.zeros(width)
    for i in range(iters):
        B = T.T @ ZZ @ T
        S, V = np.linalg.eigh((B + B.T) / 2)
        S, V = S[::-1], V[:, ::-1]
        if i == iters - 1 or last is not None and np.max(np.abs(S[:k] - last[:k])) <= tol * max(S[0], 1e-300):
            break
        if state is not None:
            release(state[0])
        state = (frame, T)
        frame, ZZ, WW = product(state)
        T, last = orthonormal(V, WW), S
    turn = T @ np.ascontiguousarray(V[:, :k])
    found = cut_lineage(passed(state, lambda b: told(b, turn), "term string, u array<double>"))
    for used in [frame] + ([state[0]] if state else []):
        release(used)
    return SparseComponents(found, S[:k] / m)


class Vectors(MS.Block):
    """With a matrix by document, ``z`` (width, documents)."""

    def __init__(self, batches, sizes: dict, width: int):
        super().__init__(batches, sizes)
        self.z = np.zeros((width, self.m))

    def take(self, about) -> None:
        for p, v in zip(about["part"].to_pylist(), MS.whole(about["v"])):
            self.z[:, self.start[p]:self.start[p] + self.sizes[p]] = np.frombuffer(v.as_buffer(), np.float64).reshape(len(self.z), -1)
