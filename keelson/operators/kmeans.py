"""k-means (K1-K7) over an array feature column.

Assignment is numpy over Arrow batches for any number of centroids (the model
travels with the function).  A round emits per-partition sums per cluster,
added by key, so only K x (n + 2) numbers reach the driver.  The data is
persisted for the rounds (memory, then disk) and read again if lost."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete_vector

def init_first_by_key(df: DataFrame, features: str, key: str, k: int) -> np.ndarray:
    """K1 (deterministic): the K rows with the smallest key (a global top-K
    plan: per-partition top-K, then a K-row merge)."""
    rows = df.filter(complete_vector(features)).orderBy(key).select(features).limit(k).collect()
    return np.array([list(r[0]) for r in rows], dtype=float)


def init_random(df: DataFrame, features: str, k: int, seed: int = 7) -> np.ndarray:
    """K1: K random distinct rows: a random top-k (twice as many rows at each
    try) of which repeats are dropped, so that the data isn't shuffled."""
    take, ok = 2 * k, df.filter(complete_vector(features)).select(features)
    while True:
        rows = [tuple(r[0]) for r in ok.orderBy(F.rand(seed)).limit(take).collect()]
        distinct = list(dict.fromkeys(rows))
        if len(distinct) >= k or len(rows) < take:
            return np.array(distinct[:k], dtype=float)
        take *= 2


def nearest(X: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest centre; the first on ties.  A
    running minimum: memory is rows x dimensions for any number of centres."""
    best, k = np.full(X.shape[0], np.inf), np.zeros(X.shape[0], dtype=np.int64)
    for j in range(C.shape[0]):
        diff = X - C[j]
        d = np.einsum("ij,ij->i", diff, diff)
        nearer = d < best
        best[nearer], k[nearer] = d[nearer], j
    return k, best


def assign(df: DataFrame, features: str, centroids: np.ndarray, k_col: str = "k",
           d_col: str = "d2") -> DataFrame:
    """K2: nearest centroid (lowest index on ties) and its squared distance,
    for any number of centroids (numpy over Arrow batches).  A row whose vector
    is null or holds a null or NaN gets null for both."""
    C = np.asarray(centroids, dtype=float)

    @F.pandas_udf(f"{k_col} int, {d_col} double")
    def run(vectors: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({k_col: pd.Series([None] * len(vectors), dtype="Int32"), d_col: np.nan})
        ok = vectors.notna().to_numpy()
        if ok.any():
            k, d = nearest(np.stack(vectors[ok].to_numpy()).astype(float), C)
            out.loc[ok, k_col], out.loc[ok, d_col] = k, d
        return out

    whole = F.when(complete_vector(features), F.col(features).cast("array<double>"))
    # said to be nondeterministic, so that a filter on the label doesn't run it twice
    out = df.withColumn("_a", run.asNondeterministic()(whole))
    return out.withColumns({k_col: F.col(f"_a.{k_col}"),
                            d_col: F.when(F.col(f"_a.{k_col}").isNotNull(), F.col(f"_a.{d_col}"))}).drop("_a")


def update(assigned: DataFrame, features: str, dims: int, old: np.ndarray,
           k_col: str = "k") -> np.ndarray:
    """K3: new centroid = mean of members (n averages per cluster in one
    grouped aggregate); an empty cluster keeps its old centre."""
    x = col(features)
    aggs = [F.avg(x[i]).alias(f"m{i}") for i in range(dims)]
    new = old.copy()
    for r in assigned.filter(F.col(k_col).isNotNull()).groupBy(k_col).agg(*aggs).collect():
        new[int(r[k_col])] = [r[f"m{i}"] for i in range(dims)]
    return new


def cohesion(assigned: DataFrame, k_col: str = "k", d_col: str = "d2") -> DataFrame:
    """K4: per-cluster mean squared distance to the own centroid."""
    return assigned.filter(F.col(k_col).isNotNull()).groupBy(k_col).agg(F.count(F.lit(1)).alias("n"),
                                       F.avg(d_col).alias("cohesion"))


@dataclass
class KMeansResult:
    centroids: np.ndarray
    history: list = field(default_factory=list)  # (iter, overall cohesion)
    iterations: int = 0
    path: list = field(default_factory=list)     # the centroids of each round


def fit(df: DataFrame, features: str, dims: int, init: np.ndarray, max_iters: int = 10,
        tol: float | None = 0.001) -> KMeansResult:
    """K5: rounds of assign -> cohesion -> update; the last round assigns
    without an update, so labels (:func:`assign` with the result) and the
    history's last cohesion belong to the returned centroids.  Rounds end when
    the overall cohesion (the unweighted mean of the cluster cohesions) changes
    by less than tol, or after ``max_iters``.  Every round is one job that
    returns the cohesion and the new centre sums.  Rows without a complete
    vector take no part."""
    from pyspark import StorageLevel
    cents = np.asarray(init, dtype=float)
    data = df.select(features).filter(complete_vector(features)).persist(StorageLevel.MEMORY_AND_DISK)
    hist, prev, path = [], None, [cents]
    try:
        for it in range(1, max_iters + 1):
            tot = _step(data, features, cents)
            live = tot[:, 0] > 0
            overall = float(np.mean(tot[live, 1] / tot[live, 0])) if live.any() else 0.0
            hist.append((it, overall))
            if it == max_iters or (tol is not None and prev is not None and abs(prev - overall) < tol):
                break
            new = cents.copy()
            new[live] = tot[live, 2:] / tot[live, 0][:, None]
            cents, prev = new, overall
            path.append(cents)
    finally:
        data.unpersist()
    return KMeansResult(cents, hist, len(hist), path)


def _step(df: DataFrame, features: str, C: np.ndarray) -> np.ndarray:
    """One assign pass: every partition emits its per-cluster partial sums
    keyed by (k, j) (j = -2 count, -1 distance sum, 0..n-1 coordinate sums);
    the partials are summed by key, so only K x (n + 2) numbers reach the
    driver."""
    K, n = C.shape

    def run(batches):
        import pandas as pd
        import pyarrow as pa
        sums, cnt, dsum, seen = np.zeros((K, n)), np.zeros(K), np.zeros(K), False
        for b in batches:
            if not b.num_rows:
                continue
            X = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            k, d = nearest(X, C)
            np.add.at(sums, k, X)
            cnt += np.bincount(k, minlength=K)
            dsum += np.bincount(k, weights=d, minlength=K)
            seen = True
        if seen:
            vals = np.hstack([cnt[:, None], dsum[:, None], sums])
            kk, jj = np.meshgrid(np.arange(K), np.arange(-2, n), indexing="ij")
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"k": kk.ravel().astype("int32"), "j": jj.ravel().astype("int32"),
                                                           "value": vals.ravel()}), preserve_index=False)

    rows = (df.select(col(features).cast("array<double>").alias("x")).mapInArrow(run, "k int, j int, value double")
            .groupBy("k", "j").agg(F.sum("value").alias("value")).collect())
    tot = np.zeros((K, n + 2))
    for r in rows:
        tot[r["k"], r["j"] + 2] = r["value"]
    return tot


def quantise(df: DataFrame, features: str, centroids: np.ndarray, out: str = "quantised") -> DataFrame:
    """K6: replace each row by its centroid (plus k and distortion d2); null
    where the row has no complete vector."""
    C = np.asarray(centroids, dtype=float)

    @F.pandas_udf("array<double>")
    def look_up(k: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(i) else C[int(i)] for i in k])

    return assign(df, features, centroids).withColumn(out, look_up("k"))


def members(assigned: DataFrame, k: int, k_col: str = "k") -> DataFrame:
    """K7: rows of one cluster."""
    return assigned.filter(F.col(k_col) == k)


def centroid_table(spark, centroids: np.ndarray) -> DataFrame:
    rows = [(int(k), int(i), float(v)) for k, c in enumerate(centroids) for i, v in enumerate(c)]
    return spark.createDataFrame(rows, "k int, pos int, value double")


def from_rows(rows: Sequence) -> np.ndarray:
    return np.array([list(r) for r in rows], dtype=float)
