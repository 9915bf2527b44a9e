"""Benchmark decontamination by spaced-seed hashing.

A mask of ``span`` words hashes only the positions it keeps, so a substituted
word under an ignored position doesn't hide a hit.  Test and training hashes
are joined; each hit fixes an alignment (diagonal) of document and item, along
which the longest overlaps are verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import WordHashes, drop_rows, mix, odd_constants, signed, small_batches
from keelson.session import cut_lineage

# Kept (1) and ignored (0) positions; fixed values of this operator.  The first
# five fit around any two substitutions in 10 words, at some place; the last
# one around three in 15 that stand so close that every 10 words hold all of
# them.  An overlap of 20 words or more has a part of 10 to 19 words with at
# least its share, so no overlap of 10 words that is 80% equal goes unseeded.
MASKS = ("110101011", "11100111", "11011011", "111111", "1001111001", "111110000011111")
# Least words of an item that the masks are for.
SPAN = 10
# Items of 5 to 9 words are shorter than a mask: they must occur word for word.
SHORTEST = 5
# Bits of the prefilter per benchmark hash, and its least and greatest size.
BITS_PER_HASH, LEAST_BITS, MOST_BITS = 1024, 20, 28
SEED = "mask int, pos int, hash long"


def all_masks() -> list[str]:
    return [*MASKS, *("1" * n for n in range(SHORTEST, SPAN))]


def mask_hashes(h: np.ndarray, mask: str, number: int) -> np.ndarray:
    """Hash of the kept positions at every place of the mask."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(number + 1))
    for j, c in enumerate(odd_constants(len(mask), 101)):
        if mask[j] == "1":
            out += h[j:j + n] * c
    return mix(out)


def item_seeds(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, words binary, mask, pos, hash) for every seed of every item."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, masks = WordHashes(), all_masks()
        for b in batches:
            rows = []
            for item, t in zip(b["item_id"], b["text"]):
                h = words.of(t)
                use = range(len(MASKS)) if len(h) >= SPAN else [i for i, m in enumerate(masks) if len(m) == len(h)]
                for i in use:
                    rows += [(item, h.tobytes(), i, p, x)
                             for p, x in enumerate(signed(mask_hashes(h, masks[i], i)).tolist())]
            yield pd.DataFrame(rows, columns=["item_id", "words", "mask", "pos", "hash"])
    return (benchmark.select(F.col(key).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
            .filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
            .mapInPandas(run, "item_id long, words binary, " + SEED))


def prefilter(seeds: DataFrame) -> tuple[np.ndarray, int, list[int]]:
    """Bit array of two probes per benchmark hash, its size as a power of two
    (bounded by MOST_BITS whatever the benchmark's size), and the masks in use."""
    n = seeds.count()
    power = min(MOST_BITS, max(LEAST_BITS, int(n * BITS_PER_HASH).bit_length()))
    probe = F.explode(F.array(F.shiftrightunsigned("hash", 64 - power), F.expr(f"hash & {(1 << power) - 1}L")))
    words = (seeds.select(probe.alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toPandas())
    bits = np.zeros(1 << (power - 6), np.int64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    used = [r[0] for r in seeds.select("mask").distinct().collect()]
    return bits.view(np.uint64), power, sorted(used)


def probe(bits: np.ndarray, power: int, h: np.ndarray) -> np.ndarray:
    """Places whose hash may be in the benchmark."""
    def held(at: np.ndarray) -> np.ndarray:
        return (bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0
    first = np.flatnonzero(held(h >> np.uint64(64 - power)))
    return first[held(h[first] & np.uint64((1 << power) - 1))]


def candidate_rows(docs: DataFrame, bits: np.ndarray, power: int, used: list[int], key: str, text: str) -> DataFrame:
    """(doc_id, text_key, words, masks, places, hashes) of documents with a place
    that passes the prefilter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # at most 2^MOST_BITS bits

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, masks = WordHashes(), all_masks()
        for b in batches:
            each = [words.of(t) for t in b["text"]]
            size = np.fromiter(map(len, each), np.int64, len(each))
            h, end = np.concatenate(each), np.cumsum(size)
            doc, mask, pos, hashes = [], [], [], []
            for i in used:
                x = mask_hashes(h, masks[i], i)
                at = probe(shared.value, power, x)
                d = np.searchsorted(end, at, "right")
                inside = at + len(masks[i]) <= end[d]
                at, d = at[inside], d[inside]
                doc.append(d)
                mask.append(np.full(len(at), i))
                pos.append(at - (end[d] - size[d]))
                hashes.append(signed(x[at]))
            doc, mask, pos, hashes = map(np.concatenate, (doc, mask, pos, hashes))
            rows = []
            for d in np.unique(doc).tolist():
                s = doc == d
                rows.append((b["doc_id"].iat[d], b["text_key"].iat[d], each[d].tobytes(),
                             mask[s].tolist(), pos[s].tolist(), hashes[s].tolist()))
            yield pd.DataFrame(rows, columns=["doc_id", "text_key", "words", "masks", "places", "hashes"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_key"),
                        F.col(text).cast("string").alias("text"))
            .filter("text IS NOT NULL")
            .mapInPandas(run, f"doc_id {kind}, text_key long, words binary, masks array<int>, "
                              "places array<int>, hashes array<long>"))


def diagonal_overlaps(doc: np.ndarray, item: np.ndarray, diagonal: int, least: int,
                      share: float) -> list[tuple[int, int, int]]:
    """(from, to, equal words) in the item's positions of the overlaps on the
    diagonal: the longest segment of which ``share`` is equal, and the same in
    what is left before and behind it, down to ``least`` words.  Every segment
    of that length and share meets one of them."""
    lo, hi = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    same = doc[lo + diagonal:hi + diagonal] == item[lo:hi]
    part = Fraction(str(share))    # whole numbers: a share met exactly is met
    total = np.concatenate([[0], np.cumsum(np.where(same, part.denominator - part.numerator, -part.numerator))])
    out, rest = [], [(0, len(same))]
    while rest:
        a, z = rest.pop()
        if z - a < max(1, least):
            continue
        t = total[a:z + 1]
        # the first place with a sum as low as that of each end
        start = np.searchsorted(-np.minimum.accumulate(t), -t)
        to = int(np.argmax(np.arange(len(t)) - start))
        start, to = a + int(start[to]), a + to
        if to - start >= max(1, least):
            out.append((lo + start, lo + to, int(same[start:to].sum())))
            rest += [(a, start), (to, z)]
    return sorted(out)


def overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 10, share: float = 0.8,
             key: str = "doc_id", text: str = "text", item_key: str = "item_id",
             item_text: str = "text") -> DataFrame:
    """(doc_id, text_key, item_id, doc_from, doc_to, item_from, n_equal): the
    overlaps of at least ``min_words`` words (or the whole item, if shorter),
    of which at least ``share`` are equal; of overlaps on one diagonal that
    meet, the longest.  Positions count normal words.  None is missed for
    ``min_words`` of at least 10 and a ``share`` of at least 0.8 (see MASKS);
    below these a hit needs the words that one mask keeps.

    Null texts overlap nothing; items with fewer than 5 words are no evidence
    and match nothing; repeated rows (same id and text) give their overlaps
    once; a null document id is kept as null; empty tables give no rows.
    """
    small_batches(docs.sparkSession)
    seeds = cut_lineage(item_seeds(benchmark, item_key, item_text))
    bits, power, used = prefilter(seeds)
    empty = "doc_id long, text_key long, item_id long, doc_from int, doc_to int, item_from int, n_equal int"
    kind = docs.schema[key].dataType.simpleString()
    empty = empty.replace("doc_id long", f"doc_id {kind}")
    if not used:
        return docs.sparkSession.createDataFrame([], empty)
    rows = cut_lineage(candidate_rows(docs, bits, power, used, key, text).withColumn(
        "row", F.xxhash64("doc_id", "words")).dropDuplicates(["row"]))
    hits = (rows.select("row", F.explode(F.arrays_zip("masks", "places", "hashes")).alias("s"))
            .select("row", F.col("s.masks").alias("mask"), F.col("s.places").alias("place"), F.col("s.hashes").alias("hash")))
    pairs = (hits.join(seeds.select("item_id", "mask", "pos", "hash"), ["mask", "hash"])
             .select("row", "item_id", (F.col("place") - F.col("pos")).alias("diagonal")).distinct())
    items = seeds.select("item_id", F.col("words").alias("item")).distinct()

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, text_key, item_id, diagonal, words, item in zip(*(b[c] for c in (
                    "doc_id", "text_key", "item_id", "diagonal", "words", "item"))):
                w, x = np.frombuffer(words, np.uint64), np.frombuffer(item, np.uint64)
                out += [(doc_id, text_key, item_id, a + diagonal, z + diagonal, a, n)
                        for a, z, n in diagonal_overlaps(w, x, diagonal, min(min_words, len(x)), share)]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in empty.split(", ")])

    return (pairs.join(rows.select("row", "doc_id", "text_key", "words"), "row").join(items, "item_id")
            .select("doc_id", "text_key", "item_id", "diagonal", "words", "item")
            .mapInPandas(verify, empty).distinct())


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  **how) -> DataFrame:
    """``docs`` (all columns) without the rows that overlap the benchmark."""
    found = overlaps(docs, benchmark, key=key, text=text, **how)
    return drop_rows(docs, found, key, text)
