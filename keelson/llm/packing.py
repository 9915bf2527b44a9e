"""Packing token ids of documents into fixed-length sequences.

Documents are tokenised, cut losslessly into pieces of at most ``seq_len``
ids and dealt to shards by a hash of (id, piece).  Within a shard, best-fit
decreasing puts each piece (longest first) into the open sequence with the
least room that still takes it; a segment tree over room sizes finds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import small_batches

SHARD_CHARS = 6_000_000   # characters that a shard gets on average
PACKED = ("shard long, seq long, n_tokens int, input_ids binary, position_ids binary, "
          "cu_seqlens array<int>, doc_ids array<long>, doc_starts array<int>")


class RoomTree:
    """Segment tree over room sizes 1..n: how many open bins have each room.
    Finds the smallest room of at least r that some bin has."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()   # above n
        self.tree = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(n + 1)]

    def add(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.tree[i] += by
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) of the best fit; None if no bin fits."""
        if least >= self.size:
            return None
        i = least + self.size
        if not self.tree[i]:
            while i > 1 and (i & 1 or not self.tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        room = i - self.size
        self._change(room, -1)
        return room, self.bins[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item indexes; items are taken longest first (ties: given order)."""
    tree, bins = RoomTree(capacity), []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        if n > capacity:
            raise ValueError("an item is longer than a bin")
        found = tree.take(n)
        if found is None:
            room, b = capacity, len(bins)
            bins.append([])
        else:
            room, b = found
        bins[b].append(i)
        if room > n:
            tree.add(room - n, b)
    return bins


def tokenise(docs: DataFrame, vocabulary: str, pattern: str, seq_len: int, shards: int,
             dtype: str, key: str, text: str) -> DataFrame:
    """(shard, doc_id, has_id, start, ids): the pieces of every document, dealt to
    shards by their place, so that copies of a document lie in all of them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from keelson.llm.bytebpe import IdEncoder
        enc = IdEncoder(vocabulary, pattern, dtype)
        step = seq_len * enc.dtype.itemsize
        for b in batches:
            rows = []
            for doc, has, t in zip(b["doc_id"], b["has_id"], b["text"]):
                ids = enc.encode(t)
                rows += [(doc, has, p // enc.dtype.itemsize, ids[p:p + step]) for p in range(0, len(ids), step)]
            yield pd.DataFrame(rows, columns=["doc_id", "has_id", "start", "ids"])

    doc = F.col(key).cast("long")
    pieces = (docs.select(F.coalesce(doc, F.lit(0)).alias("doc_id"), doc.isNotNull().alias("has_id"), F.col(text).cast("string").alias("text"))
              .filter("text != ''")
              .mapInPandas(run, "doc_id long, has_id boolean, start int, ids binary"))
    return pieces.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).alias("shard"), "*")


def pack(docs: DataFrame, vocabulary: str, pattern: str, vocab_size: int, seq_len: int = 2048,
         pad_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per packed sequence (schema PACKED).

    ``input_ids`` holds ``seq_len`` little-endian ids (uint16 if the
    vocabulary and ``pad_id`` fit, else uint32), padded at the end with
    ``pad_id``; ``position_ids`` (same type) starts at 0 in every segment and
    in the padding; ``cu_seqlens`` are the cumulative segment lengths from 0;
    segment i holds ids ``doc_starts[i]`` and following of ``doc_ids[i]``, so
    :func:`segments` gives all ids back.  A shard's memory is bounded: pieces
    are at most one sequence long and the number of shards follows the
    corpus' characters.

    Null and empty texts have no ids and are in no sequence; a null id is null
    in ``doc_ids``; repeated rows are packed as often as they occur; an empty
    table gives no rows.
    """
    small_batches(docs.sparkSession)
    dtype = "<u2" if max(vocab_size - 1, pad_id, seq_len - 1) < 2 ** 16 else "<u4"
    chars = docs.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    shards = max(1, -(-int(chars) // SHARD_CHARS))
    pieces = tokenise(docs, vocabulary, pattern, seq_len, shards, dtype, key, text)

    def run(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        kind = np.dtype(dtype)
        group = group.sort_values(["has_id", "doc_id", "start", "ids"], ignore_index=True)
        ids = [np.frombuffer(x, kind) for x in group["ids"]]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        doc = [i if has else None for i, has in zip(group["doc_id"].tolist(), group["has_id"].tolist())]
        start = group["start"].tolist()
        place = np.arange(seq_len, dtype=kind)
        rows = []
        for n, items in enumerate(best_fit_decreasing(lengths, seq_len)):
            row, pos = np.full(seq_len, pad_id, kind), np.zeros(seq_len, kind)
            ends = np.cumsum(lengths[items]).tolist()
            for i, end in zip(items, ends):
                row[end - len(ids[i]):end] = ids[i]
                pos[end - len(ids[i]):end] = place[:len(ids[i])]
            pos[ends[-1]:] = place[:seq_len - ends[-1]]
            rows.append((keys[0], n, ends[-1], row.tobytes(), pos.tobytes(), [0, *ends],
                         [doc[i] for i in items], [start[i] for i in items]))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in PACKED.split(", ")])

    return pieces.groupBy("shard").applyInPandas(run, PACKED)


def matrices(packed: DataFrame, rows: int = 256) -> DataFrame:
    """(shard, block, n_rows, ids, positions, cu_seqlens, row_offsets): blocks
    of at most ``rows`` sequences as row-major matrices; ``cu_seqlens`` are the
    blocks' lists one after the other, row i's at row_offsets[i]."""
    def run(keys: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("seq")
        sizes = np.fromiter(map(len, g["cu_seqlens"]), np.int32, len(g))
        return pd.DataFrame([(keys[0], keys[1], len(g), b"".join(g["input_ids"]), b"".join(g["position_ids"]),
                              np.concatenate(g["cu_seqlens"].tolist()).astype("<i4").tobytes(),
                              np.concatenate([[0], np.cumsum(sizes)]).astype("<i4").tobytes())],
                            columns=["shard", "block", "n_rows", "ids", "positions", "cu_seqlens", "row_offsets"])
    return (packed.withColumn("block", F.floor(F.col("seq") / rows)).groupBy("shard", "block")
            .applyInPandas(run, "shard long, block long, n_rows int, ids binary, positions binary, "
                                "cu_seqlens binary, row_offsets binary"))


def write_matrices(packed: DataFrame, path: str, rows: int = 256) -> None:
    """Write :func:`matrices` as Parquet under ``path`` (any Spark file system)."""
    matrices(packed, rows).write.mode("overwrite").parquet(path)


def segments(packed: DataFrame, seq_len: int, dtype: str = "<u2") -> DataFrame:
    """(doc_id, start, ids array<int>): the packed pieces, read back."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for ids, cu, docs, starts in zip(b["input_ids"], b["cu_seqlens"], b["doc_ids"], b["doc_starts"]):
                row = np.frombuffer(ids, dtype)
                rows += [(d, s, row[cu[i]:cu[i + 1]].astype(np.int32)) for i, (d, s) in enumerate(zip(docs, starts))]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "ids"])
    return packed.select("input_ids", "cu_seqlens", "doc_ids", "doc_starts").mapInPandas(
        run, "doc_id long, start int, ids array<int>")
