"""Alternating least squares over blocks with routing tables.

Ratings are dealt to user blocks and to item blocks once, as rows (entity,
partners, ratings), and stay there; an entity with very many ratings is cut
into several rows.  A routing table says which blocks need a partner's factors.
A half-step ships each factor once to each block that needs it, packed by block,
and solves every entity's normal equations there (numpy); only the sums of
entities that were cut are moved.  Ratings are never shuffled again.  The cost
comes from the same sums, without another pass."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.many_sparse import by_row, list_of, lists, square, whole
from keelson.session import cut_lineage, cut_partitioned, numbers

# Ratings of one row of a block, and of a block; what is summed and the partners
# that are looked up at a time there.
CHUNK = 20_000
BLOCK_RATINGS = 6_000_000
SLICE = 200_000
IDS = 1_000_000
# One rating in so many (by a hash) is counted to tell which entities to cut: a
# choice of layout only, every rating is used.
COUNTED = 32
# The columns of ratings that are dealt by item before training: part and block.
ITEM_PLACE = ("item_part", "item_block")


@dataclass
class Side:
    """One direction: ``rows`` (block, id, cut, partner list, rating list, blocks of
    the partners), dealt by block, and ``routes`` (partner, blocks), dealt by
    partner.  ``cut``: the entity has other rows; ``cuts``: any has."""
    rows: DataFrame
    routes: DataFrame
    blocks: int
    kind: str
    cuts: bool


def blocks_of(ratings: DataFrame, total: int) -> int:
    return max(ratings.sparkSession.sparkContext.defaultParallelism, -(-total // BLOCK_RATINGS))


def parts_of(ratings: DataFrame, key: str, by: str) -> DataFrame:
    """(key, parts): the few keys with more ratings than ``CHUNK``, about, and the
    rows to cut them into."""
    return cut_lineage(ratings.filter(F.pmod(F.xxhash64(key, by), F.lit(COUNTED)) == 0).groupBy(key)
                       .agg(F.ceil(F.count(F.lit(1)) * COUNTED / CHUNK).alias("parts")).filter("parts > 1"))


def placed(ratings: DataFrame, key: str, by: str, blocks: int, name: str,
           parts: DataFrame | None = None) -> tuple[DataFrame, bool]:
    """``ratings`` with the part, ``name``_part (null: its key isn't cut), and the
    block, ``name``_block, that ``key`` puts them in; and whether any key is cut.
    ``parts``: (key, parts) if known."""
    parts = (parts_of(ratings, key, by) if parts is None else parts).select(F.col(key).alias("_key"), "parts")
    part = F.pmod(F.xxhash64(by), F.col("parts")).cast("int")
    block = F.pmod(F.xxhash64(key, F.coalesce(F.col(f"{name}_part"), F.lit(0))), F.lit(blocks)).cast("int")
    block = F.element_at(F.array(*map(F.lit, numbers(ratings.sparkSession, blocks))), block + 1)
    met = ratings.join(F.broadcast(parts), F.col(key).eqNullSafe(F.col("_key")), "left")
    return met.withColumn(f"{name}_part", part).withColumn(f"{name}_block", block).drop("_key", "parts"), not parts.isEmpty()


def dealt(ratings: DataFrame, id: Column, other: Column, y: Column, part: Column, block: Column, theirs: Column,
          blocks: int) -> DataFrame:
    """The rows of a side, one shuffle of the ratings."""
    r = ratings.select(block.alias("block"), id.alias("id"), part.alias("part"), other.alias("other"), y.alias("y"), theirs.alias("theirs"))
    rows = (r.repartition(blocks, "block").groupBy("block", "id", "part").agg(F.collect_list(F.struct("other", "y", "theirs")).alias("e"))
            .select("block", "id", F.col("part").isNotNull().alias("cut"), F.col("e.other").alias("other"), F.col("e.y").alias("y"),
                    F.array_distinct("e.theirs").alias("blocks")))
    return cut_partitioned(rows, blocks, "block")


def deal(ratings: DataFrame, entity: str, partner: str, rating: str, total: int) -> Side:
    """One side alone.  ``ratings`` is read three times: written, or cheap to read."""
    blocks = blocks_of(ratings, total)
    r = ratings.select(F.col(entity).alias("id"), F.col(partner).alias("other"), F.col(rating).cast("double").alias("y"))
    r, cuts = placed(r, "id", "other", blocks, "id")
    rows = dealt(r, *map(F.col, ("id", "other", "y", "id_part", "id_block")), F.lit(0), blocks)
    routes = (r.select("other", F.col("id_block").alias("block")).distinct()
              .groupBy("other").agg(F.collect_list("block").alias("blocks")))
    return Side(rows, cut_partitioned(routes, blocks, "other"), blocks, ratings.schema[entity].dataType.simpleString(), cuts)


def deal_both(ratings: DataFrame, user: str, item: str, rating: str, total: int,
              blocks: int | None = None) -> tuple[Side, Side]:
    """The users' and the items' side.  A side's routes are the blocks that the
    other side's rows name, so no rating moves for them.  ``blocks``: the ratings
    are dealt to so many by item (``ITEM_PLACE``) and stay there for the items'
    side.  ``ratings`` is read five times: written, or cheap to read."""
    dealt_by_item, blocks = blocks is not None, blocks or blocks_of(ratings, total)
    place = [F.col(c).alias(n) for c, n in zip(ITEM_PLACE, ("i_part", "i_block"))] if dealt_by_item else []
    r = ratings.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col(rating).cast("double").alias("y"), *place)
    r, cut_users = placed(r, "u", "i", blocks, "u")
    if dealt_by_item:
        cut_items = not r.filter(F.col("i_part").isNotNull()).isEmpty()
    else:
        r, cut_items = placed(r, "i", "u", blocks, "i")
    users = dealt(r, *map(F.col, ("u", "i", "y", "u_part", "u_block", "i_block")), blocks)
    items = dealt(r, *map(F.col, ("i", "u", "y", "i_part", "i_block", "u_block")), blocks)

    def routes(rows: DataFrame) -> DataFrame:
        named = rows.select(F.col("id").alias("other"), "blocks").repartition(blocks, "other")
        return cut_partitioned(named.groupBy("other").agg(F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks")), blocks, "other")

    kinds = [ratings.schema[c].dataType.simpleString() for c in (user, item)]
    return Side(users, routes(items), blocks, kinds[0], cut_users), Side(items, routes(users), blocks, kinds[1], cut_items)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (other, f, blocks) as one row a block and batch: (block, others, f)."""
    for b in batches:
        blocks, n = lists(pa.chunked_array([b.column("blocks")]), np.int32)
        order = np.argsort(blocks, kind="stable")
        if not len(order):
            continue
        at, blocks = np.repeat(np.arange(b.num_rows), n)[order], blocks[order]
        starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        f, width = lists(pa.chunked_array([b.column("f")]), np.float64)
        k = int(width[0])
        ends = np.r_[starts, len(at)].astype(np.int32)
        yield pa.record_batch([pa.array(blocks[starts]), pa.ListArray.from_arrays(pa.array(ends), b.column("other").take(pa.array(at))),
                               pa.ListArray.from_arrays(pa.array(ends * np.int32(k)), pa.array(f.reshape(-1, k)[at].ravel()))],
                              names=["block", "others", "f"])


def half_step(side: Side, fixed: DataFrame, k: int, lam: float) -> DataFrame:
    """(id, f array, err): the factors that minimise the cost for fixed partner
    factors (id, f), and each entity's sum of squared errors with them.  Ratings
    whose partner has no factors don't count, those that are null count as 0 in
    the factors and not in the error; entities without any are left out."""
    upper = np.triu_indices(k)
    u = len(upper[0])
    size = 2 * u + k + 2

    def solve(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Factors and squared errors from sums: v v', y v, y^2, their number, and
        v v' of the null ratings."""
        A, N = np.zeros((2, len(sums), k, k))
        A[:, upper[0], upper[1]] = A[:, upper[1], upper[0]] = sums[:, :u]
        N[:, upper[0], upper[1]] = N[:, upper[1], upper[0]] = sums[:, -u:]
        b = sums[:, u:u + k]
        f = np.linalg.solve(A + lam * np.eye(k), b[:, :, None])[:, :, 0] if len(sums) else np.zeros((0, k))
        return f, np.maximum(sums[:, u + k] - 2 * (f * b).sum(axis=1) + np.einsum("ni,nij,nj->n", f, A - N, f), 0.0)

    def result(ids, f=None, err=None, s=None) -> pa.Table:
        none = lambda t: pa.nulls(len(ids), t)
        return pa.table({"id": ids, "f": none(pa.list_(pa.float64())) if f is None else list_of(f),
                         "err": none(pa.float64()) if err is None else pa.array(err),
                         "s": none(pa.list_(pa.float64())) if s is None else list_of(s)})

    def normals(rows: pa.Table, sent: pa.Table) -> pa.Table:
        """A block's entities, solved; of those that are cut the sums."""
        if not rows.num_rows or not sent.num_rows:
            return result(rows["id"].slice(0, 0))
        # a block is read batch by batch: neither its ratings nor the ids are held twice
        ids, others = pc.list_flatten(sent["others"]), pc.list_flatten(rows["other"])
        at = np.full(len(others), -1, dtype=np.int32)
        for start in range(0, len(ids), IDS):
            found = pc.index_in(others, value_set=ids.slice(start, IDS)).fill_null(-1).to_numpy()
            np.copyto(at, found + np.int32(start), where=found >= 0)
        factors = lists(sent["f"], np.float64)[0].reshape(-1, k)
        sums = np.zeros((rows.num_rows, size))
        row = seen = 0
        for b in rows.select(["y"]).to_batches():
            y, n = lists(pa.chunked_array([b.column("y")]), np.float64)
            null = np.asarray(b.column("y").flatten().is_null())
            ends = np.concatenate([[0], np.cumsum(n)])
            first = 0
            while first < len(n):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE, "right")) - 1)
                r = slice(ends[first], ends[last])
                mine = at[seen + ends[first]:seen + ends[last]]
                known = mine >= 0
                V = np.where(known[:, None], factors[mine], 0.0)
                on = known & ~null[r]
                w, m = np.where(on, y[r], 0.0), n[first:last]
                out = sums[row + first:row + last]
                vv = V[:, upper[0]] * V[:, upper[1]]
                out[:, :u] = by_row(vv, m)
                out[:, u:u + k] = by_row(V * w[:, None], m)
                out[:, u + k] = by_row(w * w, m)
                out[:, u + k + 1] = by_row(known.astype(float), m)
                if null[r].any():
                    out[:, -u:] = by_row(vv * null[r, None], m)
                first = last
            row, seen = row + len(n), seen + int(ends[-1])
        cut = np.asarray(whole(rows["cut"]))
        ids = whole(rows["id"])
        whole_on, cut_on = np.flatnonzero(~cut & (sums[:, u + k + 1] > 0)), np.flatnonzero(cut)
        return pa.concat_tables([result(ids.take(pa.array(whole_on)), *solve(sums[whole_on])),
                                 result(ids.take(pa.array(cut_on)), s=sums[cut_on])])

    def solved(key, part):
        """Sums by entity, solved."""
        codes = whole(part["id"]).dictionary_encode(null_encoding="encode")
        which = codes.indices.to_numpy()
        sums = np.zeros((len(codes.dictionary), size))
        np.add.at(sums, which, square(part["s"], size))
        on = np.flatnonzero(sums[:, u + k + 1] > 0)
        return result(codes.dictionary.take(pa.array(on)), *solve(sums[on])).select(["id", "f", "err"])

    out = f"id {side.kind}, f array<double>, err double"
    sent = (fixed.select(F.col("id").alias("other"), "f").join(side.routes, "other").select("other", "f", "blocks")
            .mapInArrow(packed, f"block int, others array<{dict(fixed.dtypes)['id']}>, f array<double>"))
    done = cut_lineage(side.rows.select("block", "id", "cut", "other", "y").groupBy("block").cogroup(sent.groupBy("block"))
                       .applyInArrow(normals, f"{out}, s array<double>"))
    if not side.cuts:
        return done.select("id", "f", "err")
    rest = done.filter(F.col("s").isNotNull()).withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(side.blocks)).cast("int"))
    return cut_lineage(done.filter(F.col("f").isNotNull()).select("id", "f", "err")
                       .unionByName(rest.select("bucket", "id", "s").groupBy("bucket").applyInArrow(solved, out)))


def sweeps(ratings: DataFrame, T0: DataFrame, k: int, lam: float, iters: int, user: str, item: str,
           rating: str, blocks: int | None = None) -> tuple[DataFrame, DataFrame, list[tuple[int, float]]]:
    """(X, T, [(sweep, cost)]) from user factors ``T0`` (user, t0, t1, ..): X (item,
    x0, ..) and T (user, t0, ..).  A null user or item has factors that no one
    else's depend on, whose errors don't count.  ``blocks``: see :func:`deal_both`.
    ``ratings`` is read several times: written, or cheap to read."""
    if iters < 1:
        raise ValueError("at least one sweep")
    users, items = deal_both(ratings, user, item, rating, ratings.count() if blocks is None else 0, blocks)
    T = T0.select(F.col(user).alias("id"), F.array(*[F.col(f"t{f}").cast("double") for f in range(k)]).alias("f"))
    X, hist = None, []
    norm = F.coalesce(F.sum(F.aggregate("f", F.lit(0.0), lambda a, v: a + v * v)), F.lit(0.0))
    err = F.coalesce(F.sum(F.when(F.col("id").isNotNull(), F.col("err"))), F.lit(0.0))
    for sweep in range(1, iters + 1):
        X = half_step(items, T, k, lam)
        T = half_step(users, X, k, lam)
        t = T.agg(norm.alias("n"), err.alias("e")).first()
        hist.append((sweep, float(0.5 * t["e"] + 0.5 * lam * (t["n"] + X.agg(norm.alias("n")).first()["n"]))))
    wide = lambda df, name, c: df.select(F.col("id").alias(name), *[F.col("f")[i].alias(f"{c}{i}") for i in range(k)])
    return wide(X, item, "x"), wide(T, user, "t"), hist


def train(ratings: DataFrame, T0: DataFrame, k: int, lam: float, iters: int = 5, user: str = "user", item: str = "item",
          rating: str = "rating", blocks: int | None = None) -> tuple[DataFrame, DataFrame, list[tuple[int, float]]]:
    """:func:`sweeps`; rows with a null user, item or rating don't count."""
    return sweeps(ratings.select(user, item, rating, *(() if blocks is None else ITEM_PLACE)).filter(
        F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(rating).isNotNull() & ~F.isnan(F.col(rating).cast("double"))),
        T0, k, lam, iters, user, item, rating, blocks)
