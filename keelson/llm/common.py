"""Helpers shared by the corpus operators: word hashing, batch sizing,
session settings and connected components."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import cut_lineage

# Entries of the per-worker word cache; when full it starts anew (memory bound).
CACHE_ENTRIES = 150_000
# Rows of one Arrow batch sent to a Python worker.
BATCH_ROWS = 512


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch, so that long texts fit a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, led by as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def words_of(text: str | None) -> list[str]:
    """Normal words of a text: split at white space, lower case, letters and
    digits only; words left empty are dropped."""
    return [w for w in (normal(raw) for raw in (text or "").split()) if w]


# Signs that words often begin or end with.
EDGES = ".,;:!?\"'()[]|&#$%*-"


def normal(raw: str) -> str:
    """The letters and digits of a word, in lower case."""
    low = raw.lower()
    if low.isalnum():
        return low
    core = low.strip(EDGES)
    return core if core.isalnum() else "".join(filter(str.isalnum, core))


class Recent(dict):
    """word -> f(word) for the words met lately: when CACHE_ENTRIES are held
    they become the old ones, of which those met again stay."""

    def __init__(self, f):
        super().__init__()
        self.f, self.old = f, {}

    def __missing__(self, raw):
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        v = self.old.get(raw)
        if v is None:
            v = self.f(raw)
        self[raw] = v
        return v


def word_hash(raw: str) -> int:
    """64-bit hash of a word's normal form; 0 if nothing is left of it."""
    norm = normal(raw)
    return (xxhash.xxh3_64_intdigest(norm) or 1) if norm else 0


class WordHashes(Recent):
    """raw word -> word_hash."""

    def __init__(self):
        super().__init__(word_hash)

    def of(self, text: str | None) -> np.ndarray:
        """Hashes of the normal words of ``text``, in order."""
        raw = (text or "").split()
        h = np.fromiter(map(self.__getitem__, raw), np.uint64, len(raw))
        return h[h != 0]


MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix), wrapping arithmetic."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers from a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.uint64(seed)) | np.uint64(1)


def window_hashes(h: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """Hash of every window of ``k`` words (empty if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    c = odd_constants(k, seed)
    out = h[:n] * c[0]
    for j in range(1, k):
        out += mix(h[j:j + n] + c[j]) if j & 1 else h[j:j + n] * c[j]
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


# Tasks that one node's neighbours are dealt to.
STAR_SALTS = 16


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """(id, component): component is the smallest id reachable over ``edges``.

    Alternating large-star / small-star rounds; each round is two grouped
    minima, materialised with a reliable checkpoint.  A node's neighbours are
    never gathered in one row: the minimum is aggregated (with map-side
    partials) and joined back.  Rows with a null end or a loop are ignored.
    """
    e = (edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
         .filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
         .distinct())
    e = cut_lineage(e)

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m0")).select(
            "u", F.least("u", "m0").alias("m"))
        # a node with very many neighbours is dealt to several tasks by them
        j = (both.withColumn("_s", F.pmod(F.xxhash64("v"), F.lit(STAR_SALTS)).cast("int"))
             .join(low.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(STAR_SALTS - 1)))), ["u", "_s"]).drop("_s"))
        if large:
            out = j.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                low.select("u", F.col("m").alias("v")))
        return out.filter("u != v").distinct()

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    before = state(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        e = cut_lineage(star(star(e, True), False))
        now = state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")))
            .groupBy("id").agg(F.min("component").alias("component")))


# Rows of an id list that may be broadcast (16 bytes each); beyond, a shuffle join.
BROADCAST_IDS = 500_000


def drop_rows(docs: DataFrame, bad: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows named by ``bad`` (doc_id, text_key =
    xxhash64 of the text).  The list is written and counted first; a short one
    is broadcast, a longer one joined by shuffle."""
    bad = cut_lineage(bad.select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_text")).distinct())
    few = bad.count() <= BROADCAST_IDS
    on = F.col(key).eqNullSafe(F.col("_bad_id")) & (F.xxhash64(text) == F.col("_bad_text"))
    return docs.join(F.broadcast(bad) if few else bad, on, "left_anti")

