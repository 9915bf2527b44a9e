"""Exact nearest neighbours by a block matrix join.

Vectors are packed into blocks; each block holds the vectors, their int8
codes (``x = scale * code + e``) and the norms of x and e.  Query blocks meet
all candidate blocks through a join on slots.  A tile multiplies the int8
codes, which gives every squared distance with an error bound; a pair survives
if its lower bound does not exceed the k-th smallest upper bound of its query.
Survivors are recomputed in double precision and kept in bounded heaps.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import small_batches

QUERY_ROWS = 256          # queries in a block
CANDIDATE_ROWS = 2048     # candidates in a block
PART_BLOCKS = 8           # candidate blocks that a packing task makes
SLOTS = 512               # most slots (groups of candidate blocks) of the join
HEAPS = 20_000            # queries with an open heap in a task; then they are sent on
PAIRS = 32_768            # survivors recomputed at once
# int8 products sum exactly in float32 up to this dimension (127^2 d < 2^24).
FLOAT32_DIMS = 1040
BLOCK = ("slot long, dim int, ids binary, vectors binary, codes binary, scale binary, "
         "norm binary, err binary")


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>) of usable rows: id not null, vector not null, not
    empty, not all zero, every component present and finite.  Exact repeats of
    a row count once."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .filter(fine & F.exists("v", lambda x: x != 0)).distinct())


def encode_block(slot: int, ids: np.ndarray, x: np.ndarray) -> dict:
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = np.finfo(float).tiny
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    e = x - scale[:, None] * codes
    return {"slot": slot, "dim": x.shape[1], "ids": ids.tobytes(), "vectors": x.tobytes(),
            "codes": codes.tobytes(), "scale": scale.tobytes(),
            "norm": np.sqrt((x * x).sum(axis=1)).tobytes(), "err": np.sqrt((e * e).sum(axis=1)).tobytes()}


def pack(rows: int, stride: int):
    """mapInPandas body: rows of a task to blocks of at most ``rows`` vectors
    of one dimension; block number = task * stride + position."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() * stride
        held: dict[int, tuple[list, list]] = {}

        def out(ids, vs):
            nonlocal number
            number += 1
            return pd.DataFrame([encode_block(number - 1, np.array(ids, np.int64), np.array(vs, np.float64))])

        for b in batches:
            for i, v in zip(b["id"], b["v"]):
                ids, vs = held.setdefault(len(v), ([], []))
                ids.append(i)
                vs.append(v)
                if len(ids) == rows:
                    yield out(*held.pop(len(v)))
        for ids, vs in held.values():
            yield out(ids, vs)
    return run


class Block:
    def __init__(self, row, side: str):
        get = lambda name, kind: np.frombuffer(getattr(row, f"{side}_{name}"), kind)
        d = row.dim
        self.ids = get("ids", np.int64)
        self.x = get("vectors", np.float64).reshape(-1, d)
        exact = np.float32 if d <= FLOAT32_DIMS else np.float64
        self.codes = get("codes", np.int8).reshape(-1, d).astype(exact)
        self.scale, self.norm, self.err = (get(n, np.float64) for n in ("scale", "norm", "err"))


def exact_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise Euclidean distances, components summed in order."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        d = a[:, j] - b[:, j]
        total += d * d
    return np.sqrt(total)


def tile(q: Block, c: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, candidate ids, distances): every query's k nearest in the
    tile, ties to smaller ids; the query's own id takes no part."""
    dot = (q.codes @ c.codes.T).astype(np.float64) * q.scale[:, None] * c.scale[None, :]
    slack = (q.err[:, None] * c.norm[None, :] + q.norm[:, None] * c.err[None, :]
             + q.err[:, None] * c.err[None, :])
    middle = (q.norm ** 2)[:, None] + (c.norm ** 2)[None, :] - 2 * dot
    slack = 2 * slack + 1e-9 * ((q.norm ** 2)[:, None] + (c.norm ** 2)[None, :])
    own = q.ids[:, None] == c.ids[None, :]
    high = np.where(own, np.inf, middle + slack)
    kth = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] > k else np.full(len(q.ids), np.inf)
    qi, ci = np.nonzero(~((middle - slack) > kth[:, None]) & ~own)
    dist = np.empty(len(qi))
    for s in range(0, len(qi), PAIRS):
        p = slice(s, s + PAIRS)
        dist[p] = exact_distances(q.x[qi[p]], c.x[ci[p]])
    order = np.lexsort((c.ids[ci], dist, qi))
    qi, ci, dist = qi[order], ci[order], dist[order]
    first = np.searchsorted(qi, qi, "left")
    top = np.arange(len(qi)) - first < k
    return q.ids[qi[top]], c.ids[ci[top]], dist[top]


def search_tiles(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heaps: dict[int, list] = {}

        def flush():
            rows = [(q, -i, -d) for q, h in heaps.items() for d, i in h]
            heaps.clear()
            return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

        for b in batches:
            for row in b.itertuples(index=False):
                for qid, cid, d in zip(*(x.tolist() for x in tile(Block(row, "q"), Block(row, "c"), k))):
                    h = heaps.setdefault(qid, [])
                    item = (-d, -cid)
                    if len(h) < k:
                        heapq.heappush(h, item)
                    elif item > h[0]:
                        heapq.heapreplace(h, item)
                if len(heaps) > HEAPS:
                    yield flush()
        if heaps:
            yield flush()
    return run


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 10, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest candidates
    by Euclidean distance, nearest first, ties to the smaller id.

    Rows that :func:`valid_vectors` drops take no part; vectors of another
    length than the query's are no candidates; fewer than k candidates are all
    returned; an empty side gives no rows.  Ids should be unique: exact
    repeats count once, an id with several vectors is listed once for each.
    """
    spark = candidates.sparkSession
    small_batches(spark, 64)
    q, c = (valid_vectors(x, id_col, vec_col) for x in (queries, candidates))
    parts = max(1, -(-candidates.count() // (CANDIDATE_ROWS * PART_BLOCKS)))
    q_parts = max(1, -(-queries.count() // (QUERY_ROWS * PART_BLOCKS)))
    slots = min(SLOTS, parts * PART_BLOCKS)
    stride = 1 << 20
    qb = q.repartition(q_parts).mapInPandas(pack(QUERY_ROWS, stride), BLOCK)
    cb = c.repartition(parts).mapInPandas(pack(CANDIDATE_ROWS, stride), BLOCK)
    names = ["ids", "vectors", "codes", "scale", "norm", "err"]
    # consecutive numbers within a task, tasks PART_BLOCKS apart: blocks spread evenly over the slots
    number = F.shiftright("slot", 20) * PART_BLOCKS + F.col("slot") % stride
    cb = cb.select(F.pmod(number, F.lit(slots)).cast("int").alias("slot"), "dim",
                   *[F.col(n).alias(f"c_{n}") for n in names])
    qb = qb.select(F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), "dim",
                   *[F.col(n).alias(f"q_{n}") for n in names])
    # Spark takes the repeated query blocks for as small as the blocks before the
    # explode: without a hint it would broadcast all of them through the driver.
    found = cb.hint("merge").join(qb.hint("merge"), ["slot", "dim"]).mapInPandas(
        search_tiles(k), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
