"""Similarity join of word-shingle sets by chosen paths.

A set is embedded as ``COORDS`` min-hash values, i.e. sampled tokens.  A run
starts with all sets; at every node of its tree each coordinate is chosen with
probability 1 / (LAM * COORDS) by a hash of the path, and the sets are split by
their value there, so a pair of similarity s stays together on s / LAM children
on average.  Small buckets are compared by brute force, larger ones split
again; buckets still large at the last level are cut into block pairs.  The
number of runs follows from the target recall.

Pairs whose embedding agrees enough only link sets into candidate groups
(spanning edges, never all pairs).  Within a group, exact Jaccard similarities
of the whole shingle sets are computed block by block; each set keeps its
number of links and the spanning edges of the exact graph.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import (WordHashes, connected_components, drop_rows, mix, odd_constants, signed,
                                small_batches, window_hashes)
from keelson.session import cut_lineage

COORDS = 128          # min-hash values of a set
LAM = 0.7             # inverse of the mean number of children that identical sets share
DEPTH = 4             # most levels of a run
LEAF = 64             # a bucket of at most so many sets isn't split further
BUCKET_BLOCK = 4096   # sets in a block of a large bucket
BLOCK = 512           # sets in a block of a candidate group
BLOCK_SHINGLES = 400_000   # and shingles in it
SIGMAS = 4.0          # how far below the threshold an estimate may lie
COLUMNS = 4096        # shingles multiplied at once


def runs_for(recall: float, similarity: float) -> int:
    """Runs after which a pair of this similarity has met with probability
    ``recall``: the children that a pair shares are Poisson, so a run misses it
    with q(0) = 0, q(d) = exp(-(similarity / LAM) (1 - q(d - 1)))."""
    q = 0.0
    for _ in range(DEPTH):
        q = math.exp(-(similarity / LAM) * (1 - q))
    return math.ceil(math.log(1 - recall) / math.log(q))


def shingle_set(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word windows; all words together, if
    there are fewer than k."""
    return np.unique(window_hashes(h, min(k, max(1, len(h)))))


def embed(sets: list[np.ndarray]) -> np.ndarray:
    """Min-hash values (high 32 bits), one row for each non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), COORDS), np.uint32)
    for i, c in enumerate(odd_constants(COORDS, 3)):
        out[:, i] = np.minimum.reduceat(flat * c, starts) >> np.uint64(32)
    return out


def row_sets(docs: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """(doc_id, text_key, n, node, sig, low): n shingles, a 64-bit key of the
    set, its min-hash values and their low bytes; n = 0 without any word."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for b in batches:
            sets = [shingle_set(words.of(t), k) for t in b.pop("text")]
            n = np.fromiter(map(len, sets), np.int32, len(sets))
            full = [s for s in sets if len(s)]
            sig = iter(embed(full)) if full else iter(())
            b["n"] = n
            b["node"] = signed(np.array([mix(np.array([mix(s).sum() + np.uint64(len(s))], np.uint64))[0]
                                         for s in sets], np.uint64))
            sigs = [next(sig) if x else None for x in n]
            b["sig"] = [None if x is None else x.tobytes() for x in sigs]
            b["low"] = [None if x is None else x.astype(np.uint8).tobytes() for x in sigs]
            yield b

    return (docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_key"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
            .mapInPandas(run, f"doc_id {kind}, text_key long, n int, node long, sig binary, low binary"))


def chosen(path: np.ndarray) -> np.ndarray:
    """Which coordinates the hash of each path chooses."""
    u = mix(path[:, None] + odd_constants(COORDS, 5)[None, :])
    return u < np.uint64(int(2.0 ** 64 / (LAM * COORDS)))


def split(path: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of every chosen coordinate."""
    row, i = np.nonzero(chosen(path))
    return row, mix(path[row] * np.uint64(0x9E3779B97F4A7C15) + (sig[row, i].astype(np.uint64) << np.uint64(8))
                    + i.astype(np.uint64))


def split_rows(rows: DataFrame, runs: int | None) -> DataFrame:
    """(path, node) children; ``runs``: from the roots of so many runs, else
    from the rows' paths."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            sig = np.frombuffer(b"".join(b["sig"]), np.uint32).reshape(-1, COORDS)
            node = b["node"].to_numpy(np.int64)
            if runs is None:
                row, path = split(b["path"].to_numpy(np.int64).view(np.uint64), sig)
                yield pd.DataFrame({"path": signed(path), "node": node[row]})
                continue
            for root in odd_constants(runs, 9):
                row, path = split(np.full(len(b), root), sig)
                yield pd.DataFrame({"path": signed(path), "node": node[row]})
    return rows.mapInPandas(run, "path long, node long")


def buckets(sets: DataFrame, recall: float, similarity: float) -> DataFrame:
    """(path, node, size) of the buckets to be compared."""
    sig = sets.select("node", "sig")
    rows, leaves = split_rows(sig, runs_for(recall, similarity)), []
    for level in range(DEPTH):
        size = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        rows = cut_lineage(rows.join(size, "path"))
        last = level == DEPTH - 1
        leaves.append(rows if last else rows.filter(F.col("size") <= LEAF))
        if last:
            break
        large = rows.filter(F.col("size") > LEAF).select("path", "node")
        if large.isEmpty():
            break
        rows = split_rows(large.join(sig, "node"), None)
    out = leaves[0]
    for x in leaves[1:]:
        out = out.unionByName(x)
    return out


def tiles(rows: DataFrame, group: str, blocks, node: str = "node") -> DataFrame:
    """``rows`` with (i, j, block): each row goes to the block pairs of its
    group that hold its block; one pair (0, 0), if the group is one block."""
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    return (rows.withColumn("_n", blocks.cast("int"))
            .withColumn("block", F.pmod(F.xxhash64(node, group), F.col("_n")).cast("int"))
            .withColumn("_o", other)
            .withColumn("i", F.least("block", "_o")).withColumn("j", F.greatest("block", "_o"))
            .drop("_n", "_o"))


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of 0..n-1's component over the edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Complete groups of rows that come sorted by ``keys``, several at a time
    (those that end within a batch)."""
    held = []
    for b in batches:
        if not len(b):
            continue
        k = b[keys].to_numpy()
        change = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        if held and (held[-1][keys].to_numpy()[-1] != k[0]).any():
            yield pd.concat(held, ignore_index=True)
            held = []
        if len(change):
            cut = int(change[-1])
            yield pd.concat([*held, b.iloc[:cut]], ignore_index=True)
            held = [b.iloc[cut:]]
        else:
            held.append(b)
    if held:
        yield pd.concat(held, ignore_index=True)


def bounds(b: pd.DataFrame, keys: list[str]) -> np.ndarray:
    k = b[keys].to_numpy()
    return np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1, [len(b)]])


def near_pairs(low: np.ndarray, block: np.ndarray, i: int, j: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of a tile whose low bytes agree in at least ``least`` of the
    coordinates: within the block, or between the two blocks."""
    left = np.flatnonzero(block == i)
    right = left if i == j else np.flatnonzero(block == j)
    step, a, b = max(1, 2_000_000 // max(1, len(right) * COORDS) * 4), [], []
    for s in range(0, len(left), step):
        part = left[s:s + step]
        same = (low[part][:, None, :] == low[right][None, :, :]).sum(axis=2, dtype=np.uint16)
        x, y = np.nonzero(same >= least * COORDS)
        a.append(part[x])
        b.append(right[y])
    a, b = np.concatenate([*a, np.empty(0, np.int64)]), np.concatenate([*b, np.empty(0, np.int64)])
    keep = a < b if i == j else np.ones(len(a), bool)
    return a[keep].astype(np.int64), b[keep].astype(np.int64)


def candidate_edges(leaves: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): spanning edges of the buckets' pairs whose estimate may reach
    the threshold."""
    least = similarity - SIGMAS * math.sqrt(similarity * (1 - similarity) / COORDS)
    rows = tiles(leaves, "path", F.ceil(F.col("size") / BUCKET_BLOCK)).join(sets.select("node", "low"), "node")
    keys = ["path", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups(batches, keys):
            low = np.frombuffer(b"".join(g["low"]), np.uint8).reshape(-1, COORDS)
            node, block = g["node"].to_numpy(np.int64), g["block"].to_numpy()
            at = bounds(g, keys)
            size = np.diff(at)
            group = np.repeat(np.arange(len(size)), size)
            a, b = [], []
            small = np.repeat(size <= LEAF, size)
            row = np.flatnonzero(small)
            for d in range(1, int(size[size <= LEAF].max(initial=1))):  # pairs at distance d, of all groups at once
                x = row[(row + d < len(g))]
                x = x[group[x] == group[np.minimum(x + d, len(g) - 1)]]
                if not len(x):
                    break
                for s in range(0, len(x), 65_536):
                    p = x[s:s + 65_536]
                    hit = (low[p] == low[p + d]).sum(axis=1) >= least * COORDS
                    a.append(p[hit])
                    b.append(p[hit] + d)
                row = x
            for n in np.flatnonzero(size > LEAF).tolist():
                s = slice(at[n], at[n + 1])
                x, y = near_pairs(low[s], block[s], int(g["i"].iat[at[n]]), int(g["j"].iat[at[n]]), least)
                a.append(x + at[n])
                b.append(y + at[n])
            a, b = np.concatenate([*a, np.empty(0, np.int64)]), np.concatenate([*b, np.empty(0, np.int64)])
            # spanning edges over all buckets of the batch together
            ids, place = np.unique(node, return_inverse=True)
            label = spanning(len(ids), place[a], place[b])
            moved = label != np.arange(len(ids))
            yield pd.DataFrame({"a": ids[moved], "b": ids[label[moved]]})

    return (rows.repartition(*keys).sortWithinPartitions(*keys)
            .select("path", "i", "j", "block", "node", "low").mapInPandas(run, "a long, b long").distinct())


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, within: bool, similarity: float) -> np.ndarray:
    """Pairs (rows of ``left`` x rows of ``right``) of at least the similarity,
    by products of 0/1 matrices over the shingles that several sets hold."""
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    value, col, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    use = held[col] > 1
    number = np.cumsum(held > 1) - 1
    owner, col = owner[use], number[col[use]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    width = int(col[-1]) + 1 if len(col) else 0
    both = np.zeros((len(left), len(right)))
    place_l, place_r = np.full(len(sets), -1), np.full(len(sets), -1)
    place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
    for s in range(0, width, COLUMNS):
        x, z = np.searchsorted(col, [s, s + COLUMNS])
        o, c = owner[x:z], col[x:z] - s
        m = [np.zeros((k, min(COLUMNS, width - s)), np.float32) for k in (len(left), len(right))]
        for mat, place in zip(m, (place_l, place_r)):
            mine = place[o] >= 0
            mat[place[o[mine]], c[mine]] = 1
        both += m[0] @ m[1].T
    total = n[left][:, None] + n[right][None, :] - both
    hit = both >= similarity * total - 1e-9
    if within:
        np.fill_diagonal(hit, False)
    return hit


def exact_links(members: DataFrame, k: int, similarity: float) -> DataFrame:
    """(node, links, root) from (component, i, j, block, node, text): how many
    sets of the tile are similar to the node's, and a spanning edge."""
    keys = ["component", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for g in groups(batches, keys):
            at = bounds(g, keys)
            out = []
            for s, e in zip(at[:-1], at[1:]):
                t = g.iloc[s:e]
                node, block = t["node"].to_numpy(np.int64), t["block"].to_numpy()
                i, j = int(t["i"].iat[0]), int(t["j"].iat[0])
                sets = [shingle_set(words.of(x), k) for x in t["text"]]
                left = np.flatnonzero(block == i)
                right = left if i == j else np.flatnonzero(block == j)
                hit = similar(sets, left, right, i == j, similarity)
                links = np.zeros(len(t), np.int64)
                links[left] += hit.sum(axis=1)
                if i != j:
                    links[right] += hit.sum(axis=0)
                x, y = np.nonzero(hit)
                label = spanning(len(t), left[x], right[y])
                out.append(pd.DataFrame({"node": node, "links": links, "root": node[label]}))
            yield pd.concat(out)

    return (members.repartition(*keys).sortWithinPartitions(*keys)
            .select("component", "i", "j", "block", "node", "text").mapInPandas(run, "node long, links long, root long"))


def similarity_classes(docs: DataFrame, similarity: float = 0.8, k: int = 5, recall: float = 0.9995,
                       key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, class_id, set_id, n_links, n_copies) for every row of
    ``docs``: set_id is the smallest id with the same set of k-word shingles,
    n_copies the number of rows with it, n_links the number of other sets of
    Jaccard similarity at least ``similarity``, class_id the smallest id that
    links lead to.

    A text without any word (null, empty, signs only) links to nothing and is
    a class of its own.  Texts of fewer than k words are one shingle.  Rows
    that repeat an id and its text share a line's values; null ids stay null
    and are never the smallest, unless a class has no other.  An empty table
    gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = cut_lineage(row_sets(docs, k, key, text))
    sets = cut_lineage(rows.filter("n > 0").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_key")).alias("rep"), F.min("doc_id").alias("set_id"),
        F.count(F.lit(1)).alias("n_copies"), F.first("n").alias("n"), F.first("sig").alias("sig"),
        F.first("low").alias("low")))
    edges = candidate_edges(buckets(sets, recall, similarity), sets, similarity)
    member = cut_lineage(connected_components(edges).join(sets.select(
        F.col("node").alias("id"), "n", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key")), "id"))
    size = member.groupBy("component").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    texts = docs.select(F.col(key).alias("rep_id"), F.xxhash64(text).alias("rep_key"), F.col(text).alias("text"))
    member = member.join(texts, member["rep_id"].eqNullSafe(texts["rep_id"]) & (member["rep_key"] == texts["rep_key"]))
    member = member.select(F.col("id").alias("node"), "component", "text").dropDuplicates(["node"])
    member = tiles(member.join(size, "component"), "component", F.col("blocks"))
    links = cut_lineage(exact_links(member, k, similarity))
    n_links = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per = (sets.select("node", "set_id", "n_copies").join(n_links, "node", "left")
           .join(classes.withColumnRenamed("id", "node"), "node", "left")
           .withColumn("component", F.coalesce("component", "node")))
    least = per.groupBy("component").agg(F.min("set_id").alias("class_id"))
    per = per.join(least, "component").select("node", "set_id", "n_copies", "n_links", "class_id")
    alone = F.col("n") == 0
    return rows.select("doc_id", "text_key", "n", "node").join(per, "node", "left").select(
        "doc_id", "text_key", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("set_id")).alias("set_id"),
        F.when(alone, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(alone, 1).otherwise(F.col("n_copies")).cast("long").alias("n_copies"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` (all columns) with the document of the smallest id of each
    class; classes as :func:`similarity_classes` gives them."""
    c = similarity_classes(docs, key=key, text=text, **how)
    return drop_rows(docs, c.filter(~F.col("doc_id").eqNullSafe(F.col("class_id"))), key, text)
