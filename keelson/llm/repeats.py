"""Repeated passages by sparse suffix arrays.

Of every text only the suffixes that start at a minimiser (the word k-gram of
smallest hash among ``min_words - k + 1`` consecutive ones) are retained.  Every
passage of ``min_words`` words holds a minimiser, and equal passages hold the
same.  Suffixes whose first k-gram occurs in one text only are dropped; the
rest are sorted, neighbours give common prefix lengths, and for each length to
the left, runs of suffixes with enough common words to the right are checked
for equal words to the left.  Together that finds exactly the words that lie
in a passage of ``min_words`` words which another text holds as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import WordHashes, mix, odd_constants, signed, small_batches, window_hashes
from keelson.llm.setjoin import bounds, groups
from keelson.operators.joins import heavy_keys, join_skewed
from keelson.session import cut_lineage

SEED_WORDS = 10       # k
# Suffixes that one task sorts together; a k-gram in more places is compared
# by aggregated passage hashes, which gives the same passages.
GROUP_ROWS = 20_000
AT_ONCE = 50_000      # passages hashed at once


def minimisers(h: np.ndarray, min_words: int, k: int = SEED_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(positions, k-gram hashes) of the minimisers of all passages of
    ``min_words`` words; none in a shorter text.  Ties go to the first."""
    g = window_hashes(h, k)
    w = min_words - k + 1
    if len(g) < w:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    low, span = g, 1                      # minima over windows of doubling length
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < w:
        low = np.minimum(low[:len(g) - w + 1], low[w - span:])
    # leftmost place of each window's minimum
    at = np.unique(first_equal(g, low))
    return at, g[at]


def first_equal(g: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each window start s the first place p >= s with g[p] = low[s]."""
    order = np.lexsort((np.arange(len(g)), g))
    values = g[order]
    lo = np.searchsorted(values, low, "left")
    hi = np.searchsorted(values, low, "right")
    p = order[lo]
    s = np.arange(len(low))
    again = np.flatnonzero(p < s)          # an equal k-gram stands before the window
    for i in again.tolist():
        same = order[lo[i]:hi[i]]
        p[i] = same[np.searchsorted(same, s[i])]
    return p


def seeds_of(docs: DataFrame, min_words: int, key: str, text: str) -> DataFrame:
    """(doc_id, text_key, n_words, grams, places) of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for b in batches:
            each = [words.of(t) for t in b["text"]]
            found = [minimisers(h, min_words) for h in each]
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "text_key": b["text_key"],
                "words_key": [int(signed(mix(np.array([mix(h + np.arange(len(h), dtype=np.uint64)).sum()
                                                       + np.uint64(len(h))], np.uint64)))[0]) for h in each],
                "n_words": [len(h) for h in each],
                "grams": [signed(g) for _, g in found], "places": [p.astype(np.int32) for p, _ in found]})

    return (docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_key"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
            .mapInPandas(run, f"doc_id {kind}, text_key long, words_key long, n_words int, "
                              "grams array<long>, places array<int>"))


def contexts(found: DataFrame, min_words: int) -> DataFrame:
    """(gram, node, place, context, h) from one read of the texts: a retained
    place with the words before and from it on, as big-endian hashes that sort
    like the words (missing words are 0), and h 0; for a place of a hot k-gram
    instead the hashes h of all passages around it, place their first word and
    context null."""
    before = min_words - SEED_WORDS
    c = odd_constants(min_words, 31)
    names = ["gram", "node", "place", "context", "h"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for b in batches:
            for node, text, marks in zip(b["node"], b["text"], b["marks"]):
                h = (words.of(text) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                pad = np.concatenate([np.zeros(before, np.uint32), h, np.zeros(min_words, np.uint32)])
                at = np.array([m["place"] for m in marks], np.int64)
                hot = np.array([m["hot"] for m in marks], bool)
                gram = np.array([m["gram"] for m in marks], np.int64)
                view = np.lib.stride_tricks.sliding_window_view(pad, before + min_words)
                cold = view[at[~hot]].astype(">u4")
                out = [pd.DataFrame({"gram": gram[~hot], "node": node, "place": at[~hot], "context": [r.tobytes() for r in cold], "h": 0})]
                # a passage that starts l words before a place, once for each word it starts at
                first = np.unique(np.subtract.outer(at[hot], np.arange(before + 1)).ravel())
                first = first[(first >= 0) & (first + min_words <= len(h))]
                for lo in range(0, len(first), AT_ONCE):
                    some = first[lo:lo + AT_ONCE]
                    part = np.lib.stride_tricks.sliding_window_view(h, min_words)[some]
                    hashes = mix(mix(part.astype(np.uint64) + c[None, :]).sum(axis=1))
                    out.append(pd.DataFrame({"gram": 0, "node": node, "place": some, "context": None, "h": signed(hashes)}))
                yield pd.concat(out)[names] if len(out) > 1 else out[0][names]

    return found.mapInPandas(run, "gram long, node long, place int, context binary, h long")


def common_prefix(rows: np.ndarray) -> np.ndarray:
    """Equal leading columns of each row and the one before (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def repeated_starts(node: np.ndarray, gram: np.ndarray, context: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, l): the passages that start l words before row's place and that
    another node's row holds as well.  ``context`` has min_words - k words
    before the place and min_words from it on."""
    before = min_words - SEED_WORDS
    right = context[:, before:]
    order = np.lexsort((np.ascontiguousarray(right.astype(">u4")).view(f"V{4 * min_words}").ravel().argsort(kind="stable").argsort(kind="stable"), gram))
    node, gram, context, right = node[order], gram[order], context[order], right[order]
    lcp = common_prefix(right)
    lcp[1:][gram[1:] != gram[:-1]] = 0
    c = odd_constants(before, 77)
    left_hash = np.zeros(len(node), np.uint64)
    whole = np.ones(len(node), bool)
    rows, lengths = [], []
    for l in range(before + 1):  # noqa: E741
        if l:
            word = context[:, before - l]
            whole &= word != 0
            left_hash += mix(word.astype(np.uint64) + c[l - 1])
        need = min_words - l
        run = np.cumsum(lcp < need)                       # equal numbers: `need` common words from the place on
        ok = whole & (right[:, need - 1] != 0)
        at = np.flatnonzero(ok)
        if len(at) < 2:
            continue
        by = np.lexsort((node[at], left_hash[at], run[at]))
        at = at[by]
        new = np.append(True, (run[at][1:] != run[at][:-1]) | (left_hash[at][1:] != left_hash[at][:-1]))
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(at)) - 1
        hit = np.repeat(node[at][start] != node[at][end], np.diff(np.append(start, len(at))))
        rows.append(order[at[hit]])
        lengths.append(np.full(int(hit.sum()), l))
    return np.concatenate([*rows, np.empty(0, np.int64)]), np.concatenate([*lengths, np.empty(0, np.int64)])


def union_spans(node: np.ndarray, start: np.ndarray, length: int) -> pd.DataFrame:
    """Maximal (node, from, to) covered by passages of ``length`` words."""
    order = np.lexsort((start, node))
    node, start = node[order], start[order]
    if not len(node):
        return pd.DataFrame({"node": node, "from": start, "to": start})
    new = np.append(True, (node[1:] != node[:-1]) | (start[1:] > start[:-1] + length))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(node)) - 1
    return pd.DataFrame({"node": node[first], "from": start[first], "to": start[last] + length})


def passages(ctx: DataFrame, min_words: int) -> DataFrame:
    """(node, from, to) from the rows of :func:`contexts`."""
    width = 2 * min_words - SEED_WORDS
    schema = "node long, `from` long, `to` long"

    def sort_and_compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in groups(batches, ["gram"]):
            m = np.frombuffer(b"".join(g["context"]), ">u4").astype(np.uint32).reshape(-1, width)
            row, l = repeated_starts(g["node"].to_numpy(np.int64), g["gram"].to_numpy(np.int64), m, min_words)  # noqa: E741
            yield union_spans(g["node"].to_numpy(np.int64)[row], g["place"].to_numpy(np.int64)[row] - l, min_words)

    sorted_ = (ctx.filter("context IS NOT NULL").select("gram", "node", "place", "context")
               .repartition("gram").sortWithinPartitions("gram").mapInPandas(sort_and_compare, schema))
    every = ctx.filter("context IS NULL").select("h", "node", F.col("place").cast("long").alias("from"))
    held = every.groupBy("h").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a != z").select("h")
    # the places of one passage are dealt to several tasks
    held = held.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(15))))
    hashed = (every.withColumn("_s", F.pmod(F.xxhash64("node"), F.lit(16)).cast("int"))
              .join(held, ["h", "_s"], "left_semi")
              .select("node", "from", (F.col("from") + min_words).alias("to")))
    return sorted_.unionByName(hashed)


def merge_spans(spans: DataFrame) -> DataFrame:
    """(node, spans array<struct<from,to>>): overlapping and adjacent spans of a
    text joined; a text's list is bounded by its length."""
    arr = F.sort_array(F.collect_set(F.struct("from", "to")))
    step = ("aggregate(s, cast(array() as array<struct<`from`:bigint,`to`:bigint>>), (acc, x) -> "
            "CASE WHEN size(acc) > 0 AND x.`from` <= element_at(acc, -1).`to` THEN "
            "concat(slice(acc, 1, size(acc) - 1), array(named_struct('from', element_at(acc, -1).`from`, "
            "'to', greatest(element_at(acc, -1).`to`, x.`to`)))) ELSE concat(acc, array(x)) END)")
    return spans.groupBy("node").agg(arr.alias("s")).select("node", F.expr(step).alias("spans"))


def repeated_passages(docs: DataFrame, min_words: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, n_words, n_repeated, spans) of the rows with words in
    a passage of at least ``min_words`` words that another row holds as well;
    spans are [from, to) in normal words, maximal and in order.

    Rows with the same words repeat each other as a whole if they have enough
    words.  Repeats within one text alone don't count.  Null and short texts
    have none; a row repeated with its id counts as another row; an empty
    table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = cut_lineage(seeds_of(docs, min_words, key, text).filter(F.col("n_words") >= min_words))
    same = (rows.groupBy(F.col("words_key").alias("node")).agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_key")).alias("rep")))
    same = cut_lineage(same)
    # one row for each word sequence; the others share its spans
    reps = (rows.join(same.select(F.col("node").alias("words_key"), "rep"), "words_key")
            .filter(F.col("rep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("rep.text_key") == F.col("text_key")))
            .dropDuplicates(["words_key"])
            .select(F.col("words_key").alias("node"), "doc_id", "text_key", "grams", "places"))
    reps = cut_lineage(reps)
    marks = reps.select("node", F.explode(F.arrays_zip("grams", "places")).alias("m")).select(
        "node", F.col("m.grams").alias("gram"), F.col("m.places").alias("place"))
    shared = cut_lineage(marks.groupBy("gram").agg(
        F.min("node").alias("a"), F.max("node").alias("z"), F.count(F.lit(1)).alias("n"))
        .filter("a != z").select("gram", "n", (F.col("n") > GROUP_ROWS).alias("hot")))
    texts = docs.select(F.col(key).alias("_id"), F.xxhash64(text).alias("_key"), F.col(text).alias("text"))
    kept = join_skewed(marks, shared.select("gram", "hot"), ["gram"], "inner", heavy=heavy_keys(shared, ["gram"], "n"))
    kept = kept.groupBy("node").agg(F.collect_list(F.struct("gram", "place", "hot")).alias("marks"))
    kept = kept.join(reps.select("node", F.col("doc_id").alias("rep_id"), F.col("text_key").alias("rep_key")), "node")
    # ids repeat only where a row does, with the same text: any of them serves
    found = (kept.join(texts, F.col("rep_id").eqNullSafe(F.col("_id")) & (F.col("rep_key") == F.col("_key")))
             .select("node", "text", "marks"))
    found = passages(cut_lineage(contexts(found, min_words)), min_words)
    spans = merge_spans(found)
    per = same.filter("copies > 1").select("node", F.lit(True).alias("whole")).join(spans, "node", "full")
    return (rows.select("doc_id", "text_key", "n_words", F.col("words_key").alias("node")).join(per, "node")
            .withColumn("spans", F.when(F.col("whole"), F.array(F.struct(
                F.lit(0).cast("long").alias("from"), F.col("n_words").cast("long").alias("to")))).otherwise(F.col("spans")))
            .withColumn("n_repeated", F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["to"] - s["from"]))
            .select("doc_id", "text_key", "n_words", "n_repeated", "spans"))
