"""Vector code compression: product codebooks in whole numbers, with LAESA
pivots for the nearest entry.

Components become floor(4096 x); a vector is cut into consecutive parts, each
part position has a codebook.  Pivots are fixed points of each part position,
and every part's distances to them are computed once and written beside it.
A round measures pivots against entries only; the triangle inequality then
bounds each part's distance to each entry from below.  Entries are tried in
the order of their bounds with exact integer distances, until the next bound
exceeds the best distance.  Rounds are grouped integer sums; only codebooks
reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import small_batches
from keelson.operators.joins import join_skewed
from keelson.session import cut_lineage

SCALE = 4096
PARTS = 8
ENTRIES = 16
PIVOTS = 4
ROUNDS = 6
BATCH = 8192
# 4096 x must fit 64-bit integers.
LARGEST = float(2 ** 50)
# Relative error of a stored (single precision) distance, doubled.
SLACK = 2.0 ** -22

Books = list[np.ndarray]     # per part position: entries x width, int64 or Python integers


def cuts_of(dim: int, parts: int) -> list[tuple[int, int]]:
    """The parts' borders; equal widths if ``parts`` divides ``dim``."""
    return [(p * dim // parts, (p + 1) * dim // parts) for p in range(parts)]


def fitting(x: np.ndarray, width: int, other: int = 0) -> np.ndarray:
    """``x`` as it is if squared distances of ``width`` components fit 64 bits,
    else as Python integers."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))), other)
    return x if width * (2 * most) ** 2 < 2 ** 62 else x.astype(object)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise exact squared distances."""
    d = a - b
    return (d * d).sum(axis=-1)


def roots(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(np.float64))


def pick_pivots(books: Books, count: int = PIVOTS) -> Books:
    """Of each part position's first entries, ``count`` that lie far from each
    other: each next one has the largest sum of distances to those chosen."""
    out = []
    for entries in books:
        chosen, total = [0], np.zeros(len(entries))
        while len(chosen) < min(count, len(entries)):
            total = total + roots(squared(entries, entries[chosen[-1]]))
            total[chosen] = -1.0
            chosen.append(int(total.argmax()))
        out.append(entries[chosen])
    return out


def pivot_distances(x: np.ndarray, pivots: Books) -> np.ndarray:
    """rows x (parts * pivots), single precision."""
    cols = []
    for (a, z), points in zip(cuts_of(x.shape[1], len(pivots)), pivots):
        part = fitting(x[:, a:z], z - a, largest(points))
        cols += [roots(squared(part, p)) for p in points]
    return np.stack(cols, axis=1).astype(np.float32) if cols else np.zeros((len(x), 0), np.float32)


def largest(x: np.ndarray) -> int:
    return max((abs(int(v)) for v in x.ravel()), default=0)


def nearest_entries(part: np.ndarray, far: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(entry, squared distance, evaluations): nearest entry of each part, ties
    to the lower index, from the parts' distances ``far`` to the pivots."""
    n = len(part)
    between = np.stack([roots(squared(entries, p)) for p in pivots])
    low = np.zeros((n, len(entries)))
    for j in range(len(pivots)):
        mine = far[:, j].astype(np.float64)[:, None]
        np.maximum(low, np.abs(mine - between[j]) - SLACK * (mine + between[j]), out=low)
    order = np.argsort(low, axis=1, kind="stable")
    sorted_low = np.take_along_axis(low, order, axis=1)
    best = order[:, 0].copy()
    dist = squared(part, entries[best])
    on, tried = np.arange(n), n
    for s in range(1, len(entries)):
        on = on[sorted_low[on, s] <= roots(dist[on]) * (1 + 1e-9)]
        if not len(on):
            break
        tried += len(on)
        e = order[on, s]
        d = squared(part[on], entries[e])
        nearer = (d < dist[on]) | ((d == dist[on]) & (e < best[on]))
        best[on[nearer]], dist[on[nearer]] = e[nearer], d[nearer]
    return best, dist, tried


def assign(x: np.ndarray, far: np.ndarray, books: Books, pivots: Books) -> tuple[np.ndarray, np.ndarray, int]:
    """(rows x parts entries, rows x parts squared distances, evaluations)."""
    codes, dists, tried, at = [], [], 0, 0
    for (a, z), entries, points in zip(cuts_of(x.shape[1], len(books)), books, pivots):
        part = fitting(x[:, a:z], z - a, largest(entries))
        code, dist, t = nearest_entries(part, far[:, at:at + len(points)], entries, points)
        codes.append(code)
        dists.append(dist)
        tried += t
        at += len(points)
    return np.stack(codes, axis=1), np.stack(dists, axis=1), tried


def matrix(column: pa.Array, kind) -> np.ndarray:
    """A list column whose lists are equally long as rows x length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def round_sums(books: Books, pivots: Books):
    """mapInArrow body: (part, entry, pos, value) sums of a task's parts by
    their nearest entry; pos -1 is their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(b), b.shape[1] + 1), object) for b in books]
        seen = False
        for b in batches:
            if not b.num_rows:
                continue
            seen = True
            x = matrix(b.column("x"), np.int64)
            codes, _, _ = assign(x, matrix(b.column("far"), np.float32), books, pivots)
            for p, (a, z) in enumerate(cuts_of(x.shape[1], len(books))):
                part = fitting(x[:, a:z], max(1, len(x)))
                for e in np.unique(codes[:, p]).tolist():
                    mine = part[codes[:, p] == e]
                    total[p][e, 0] += len(mine)
                    total[p][e, 1:] += mine.sum(axis=0)
        rows = [(p, e, j - 1, str(int(v))) for p, t in enumerate(total) for e, line in enumerate(t) if line[0]
                for j, v in enumerate(line)] if seen else []
        yield pa.record_batch([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
            (pa.int32(), pa.int32(), pa.int32(), pa.string()))], names=["part", "entry", "pos", "value"])
    return run


def moved(books: Books, sums: list) -> Books:
    """Entries replaced by floor(sum / count) of their parts; unused ones stay."""
    by = {(r["part"], r["entry"], r["pos"]): int(r["value"]) for r in sums}
    out = []
    for p, entries in enumerate(books):
        new = entries.astype(object)
        for e in range(len(entries)):
            count = by.get((p, e, -1))
            if count:
                new[e] = [by[p, e, j] // count for j in range(entries.shape[1])]
        out.append(fitting(new.astype(np.int64), max(1, entries.shape[1])))
    return out


def whole_vectors(vectors: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    """(id, label, x array<bigint>) of the rows whose vector is present and has
    only finite components."""
    v = F.col(vec).cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    return (vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), v.alias("v"))
            .filter(F.col("v").isNotNull() & fine)
            .select("id", "label", F.transform("v", lambda c: F.floor(F.lit(float(SCALE)) * c)).alias("x")))


def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS,
          key: str = "vec_id", vec: str = "embedding", label: str = "label") -> tuple[DataFrame, Books]:
    """(id, label, code, error) of every usable vector, and the codebooks.

    Vectors that are null or hold null or non-finite components (or ones of
    2^50 and more, whose integers don't fit 64 bits) take no part.  Each part
    position's codebook starts as that part of the ``entries`` smallest ids
    (null ids last; equal ids by their vectors), all of them if there are
    fewer.  Vectors of another length than the first one's can't be cut alike:
    they stay with a null code and error.  An error beyond 64 bits is null.
    Repeated rows count each.  Other columns play no part.
    """
    spark = vectors.sparkSession
    small_batches(spark, BATCH)
    kept = whole_vectors(vectors, key, vec, label)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "x").limit(1).collect()
    kind = kept.schema["id"].dataType.simpleString()
    label_kind = kept.schema["label"].dataType.simpleString()
    if not first or not first[0]["x"]:
        return kept.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")), []
    dim = len(first[0]["x"])
    fits = F.size("x") == dim
    start = kept.filter(fits).orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    x = np.array([r["x"] for r in start], np.int64)
    books = [fitting(x[:, a:z], max(1, z - a)) for a, z in cuts_of(dim, parts)]
    points = pick_pivots(books, pivots)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = pivot_distances(matrix(b.column("x"), np.int64), points)
            size = far.shape[1]
            far = pa.ListArray.from_arrays(pa.array(np.arange(0, len(far) * size + 1, size, dtype=np.int32)), pa.array(far.ravel()))
            yield pa.record_batch([*b.columns, far], names=["id", "label", "x", "far"])

    # parts and their distances to the pivots: written once, read every round
    table = cut_lineage(kept.filter(fits).mapInArrow(
        measured, f"id {kind}, label {label_kind}, x array<bigint>, far array<float>"))
    for _ in range(rounds):
        sums = (table.select("x", "far").mapInArrow(round_sums(books, points), "part int, entry int, pos int, value string")
                .groupBy("part", "entry", "pos").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")))
        books = moved(books, sums.collect())      # parts x entries x (width + 1) numbers

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            code, dist, _ = assign(matrix(b.column("x"), np.int64), matrix(b.column("far"), np.float32), books, points)
            text = [row.tobytes().hex() for row in code.astype(np.uint8)]
            error = [e if e < 2 ** 63 else None for e in map(int, dist.astype(object).sum(axis=1))]
            yield pa.record_batch([b.column("id"), b.column("label"), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                                  names=["id", "label", "code", "error"])

    out = table.mapInArrow(coded, f"id {kind}, label {label_kind}, code string, error long")
    odd = kept.filter(~fits).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return out.unionByName(odd), books


def books_sha256(books: Books) -> str:
    """SHA-256 of all entries' decimal integers by part, entry, position."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for e in b for v in e).encode()).hexdigest()


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS,
               key: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of :func:`codes`:
    ``label_error`` is the error summed over the rows of equal label (nulls
    together; null beyond 64 bits or if no row of the label has an error)."""
    rows, books = codes(vectors, parts, entries, rounds, pivots, key, vec, label)
    rows = cut_lineage(rows)
    sums = rows.groupBy("label").agg(F.expr("try_cast(sum(CAST(error AS DECIMAL(20, 0))) AS BIGINT)").alias("label_error"))
    return (join_skewed(rows, sums, ["label"])
            .select(F.col("id").alias(key), "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256")))
