"""Phrase collocations by Rabin-Karp fingerprints.

A phrase of n words has the fingerprint ``sum h(word_j) B^j`` modulo 2^64; a
prefix polynomial over a block of texts gives those of all its n-grams as one
numpy subtraction each.  Two passes run over the texts:

1. every task counts the top bits of its fingerprints (buckets) and shuffles
   the counts by bucket range; buckets that reach ``min_count`` become a bit
   array of bounded size.  Counts of buckets are upper bounds of the phrases'
   counts, so no frequent phrase is lost.
2. n-grams of the buckets left are aggregated by fingerprint within a block,
   each occurrence is compared with the one pointed at word for word (what
   differs is counted apart), and only then the phrase's text is made.  Texts
   with counts and pointers are shuffled by fingerprint and added there by text,
   so the result is exact whatever collides.

Cuts, scores and containment are joins and grouped minima over the table of
frequent phrases.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import mix, small_batches
from keelson.operators.joins import join_skewed
from keelson.session import cut_lineage

MAX_WORDS = 5
BLOCK_BYTES = 4 << 20        # text of one block; a longer text is a block alone
STEP = 1 << 18               # n-grams whose fingerprints are held at once
BUFFER = 2 << 20             # buckets that a task counts before it sends them on
RANGE_BITS = 22              # buckets of one range (counted by one array)
MOST_BITS = 28               # bits of the broadcast array: 32 MB
BASE = 0x9E3779B97F4A7C15    # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
SALT = 0xC2B2AE3D27D4EB4F

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD, BLANK, END = 0, 1, 2
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = BLANK
KIND[list(b".,;:!?\n\v\f\r")] = END


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def text_hashes(texts: pa.Array) -> np.ndarray:
    """Polynomials over the bytes of some texts, mixed."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or data is None:
        return np.zeros(len(texts), np.uint64)
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].astype(np.uint64) + np.uint64(1)
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(raw * powers(BASE, len(raw)), out=prefix[1:])
    ends = ends - ends[0]
    return mix((prefix[ends[1:]] - prefix[ends[:-1]]) * powers(INVERSE, len(raw) + 1)[ends[:-1]])


class Block:
    """The words of some texts: ``codes`` (numbers of equal words), ``piece``
    (numbers of the pieces), ``doc`` (row) and ``at`` (word number in the row)."""

    def __init__(self, text: pa.Array, langs: list[str]):
        text = text.cast(pa.large_binary())
        _, offsets, data = text.buffers()
        bounds = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
        raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None else np.empty(0, np.uint8)
        bounds = bounds - bounds[0]
        low, kind = LOWER[raw], KIND[raw]
        word = kind == WORD
        begins = bounds[:-1][bounds[:-1] < len(raw)]
        first, last = np.ones(len(raw), bool), np.ones(len(raw), bool)
        first[1:], last[:-1] = ~word[:-1], ~word[1:]
        first[begins], last[begins[begins > 0] - 1] = True, True
        start, end = np.flatnonzero(word & first), np.flatnonzero(word & last) + 1
        ends = kind == END
        ends[begins] = True
        self.piece = np.searchsorted(np.flatnonzero(ends), start, "right")
        self.doc = np.searchsorted(bounds[1:], start, "right")
        self.at = np.arange(len(start)) - np.searchsorted(self.doc, np.arange(len(text)))[self.doc]
        # words and the gaps between them are one Arrow array over the same bytes
        each = np.empty(2 * len(start), np.int64)
        each[0::2], each[1::2] = start, end
        if len(start):
            coded = pa.Array.from_buffers(pa.large_binary(), len(each) - 1,
                                          [None, pa.py_buffer(each), pa.py_buffer(low)]).dictionary_encode()
            codes = coded.indices.to_numpy()[0::2]
            used = np.zeros(len(coded.dictionary), bool)
            used[codes] = True
            self.codes = (np.cumsum(used) - 1)[codes]
            self.words = coded.dictionary.filter(pa.array(used))
        else:
            self.codes, self.words = np.empty(0, np.int64), pa.array([], pa.large_binary())
        self.hashes = text_hashes(self.words)
        self.langs = sorted(set(langs))
        number = {name: i for i, name in enumerate(self.langs)}
        self.lang = np.fromiter((number[x] for x in langs), np.int64, len(langs))[self.doc]
        self.lang_hash = np.fromiter((xxhash.xxh3_64_intdigest(x.encode()) for x in self.langs), np.uint64, len(self.langs))

    def fingerprints(self, keep_bits: int = 64) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, first word's number, fingerprint) of the n-grams within pieces,
        some at a time."""
        size = min(STEP, len(self.codes)) + MAX_WORDS
        up, down = powers(BASE, size), powers(INVERSE, size)
        for lo in range(0, len(self.codes), STEP):
            part = slice(lo, lo + STEP + MAX_WORDS - 1)
            h, piece = self.hashes[self.codes[part]], self.piece[part]
            prefix = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(h * up[:len(h)], out=prefix[1:])
            for n in range(1, MAX_WORDS + 1):
                count = min(STEP, len(h) - n + 1)
                if count <= 0:
                    break
                at = np.flatnonzero(piece[:count] == piece[n - 1:count + n - 1])
                f = (prefix[at + n] - prefix[at]) * down[at]
                f = mix(f + self.lang_hash[self.lang[lo + at]] + np.uint64(n * SALT % (1 << 64)))
                yield n, lo + at, f >> np.uint64(64 - keep_bits) << np.uint64(64 - keep_bits) if keep_bits < 64 else f

    def phrases(self, at: np.ndarray, n: np.ndarray) -> pa.Array:
        """The texts of phrases of ``n`` words from words ``at``, joined by blanks."""
        ends = np.concatenate([[0], np.cumsum(n)])
        each = np.repeat(at - ends[:-1], n) + np.arange(ends[-1])
        words = self.words.take(pa.array(self.codes[each])).cast(pa.binary())
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), words), b" ")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Block]]:
    """(keys, Block) of about BLOCK_BYTES of text each."""
    held, size = [], 0
    for b in batches:
        for i in range(0, b.num_rows, 64):
            rows = b.slice(i, 64)
            held.append(rows)
            size += rows.column("text").nbytes
            if size >= BLOCK_BYTES:
                yield one_block(held)
                held, size = [], 0
    if held:
        yield one_block(held)


def one_block(held: list[pa.RecordBatch]) -> tuple[pa.Array, Block]:
    t = pa.Table.from_batches(held).combine_chunks()
    text = pa.concat_arrays([c.cast(pa.large_binary()) for c in t["text"].chunks])
    return t["key"], Block(text, t["lang"].to_pylist())


# ---- first pass: buckets --------------------------------------------------------
def encode(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted buckets of a range with their counts: gaps as planes of low and
    high bytes (the high ones are mostly 0, which the shuffle's compression
    takes away), larger gaps as escapes, and the counts over 1."""
    gaps = np.diff(buckets, prepend=0)
    wide, more = gaps >= 65535, counts > 1
    two = np.where(wide, 65535, gaps).astype("<u2").view(np.uint8).reshape(-1, 2)
    return b"".join((np.array([len(buckets), wide.sum(), more.sum()], "<u4").tobytes(), two[:, 0].tobytes(), two[:, 1].tobytes(),
                     gaps[wide].astype("<u4").tobytes(), np.packbits(more).tobytes(), counts[more].astype("<u2").tobytes()))


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, wide, more = np.frombuffer(data, "<u4", 3).tolist()
    planes, at = np.frombuffer(data, np.uint8, 2 * n, 12).astype(np.int64), 12 + 2 * n
    gaps = planes[:n] + (planes[n:] << 8)
    gaps[gaps == 65535] = np.frombuffer(data, "<u4", wide, at)
    at += 4 * wide
    bits = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at), count=n).astype(bool)
    counts = np.ones(n, np.int64)
    counts[bits] = np.frombuffer(data, "<u2", more, at + -(-n // 8))
    return np.cumsum(gaps), counts


def bucket_counts(bits: int, min_count: int):
    """mapInArrow body: (range, data) of the buckets of a task's n-grams.  A
    count is cut at ``min_count``, beyond which it says nothing more."""
    top = min(min_count, 65535)
    schema = pa.schema([("range", pa.int64()), ("data", pa.binary())])

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(held)
        held.clear()
        every.sort()
        new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        one = every[new].astype(np.int64)
        n = np.minimum(np.diff(np.append(new, len(every))), top)
        ranges, first = np.unique(one >> RANGE_BITS, return_index=True)
        cuts = np.append(first, len(one))
        data = [encode(one[a:z] - (r << RANGE_BITS), n[a:z]) for r, a, z in zip(ranges.tolist(), cuts[:-1], cuts[1:])]
        return pa.record_batch([pa.array(ranges), pa.array(data, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, block in blocks(batches):
            for _, _, f in block.fingerprints():
                b = f >> np.uint64(64 - bits)
                held.append(b.astype(np.uint32) if bits <= 32 else b)
                size += len(f)
                if size >= BUFFER:
                    yield sent(held)
                    held, size = [], 0
            del block
        if size:
            yield sent(held)
    return run


def frequent_ranges(min_count: int):
    """mapInArrow body over rows sorted by range: (slot, map) with a bit for
    each bucket that reaches ``min_count``; slot is the range's place in the
    broadcast array."""
    schema = pa.schema([("slot", pa.int64()), ("map", pa.binary())])
    slots = 1 << (MOST_BITS - RANGE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(1 << RANGE_BITS, np.int32)

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array([at % slots], pa.int64()),
                                    pa.array([np.packbits(total >= min(min_count, 65535)).tobytes()], pa.binary())], schema=schema)

        for b in batches:
            for r, data in zip(b.column("range").to_pylist(), b.column("data")):
                if r != at:
                    if at is not None:
                        yield out()
                    at, total[:] = r, 0
                where, n = decode(data.as_py())
                total[where] += n
                np.minimum(total, 1 << 30, out=total)
        if at is not None:
            yield out()
    return run


def merged_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body over rows sorted by slot: the union of a slot's maps."""
    at, held = None, None
    for b in batches:
        for slot, data in zip(b.column("slot").to_pylist(), b.column("map")):
            one = np.frombuffer(data.as_py(), np.uint8)
            if slot == at:
                held = held | one
                continue
            if at is not None:
                yield pa.record_batch([pa.array([at], pa.int64()), pa.array([held.tobytes()], pa.binary())], names=["slot", "map"])
            at, held = slot, one
    if at is not None:
        yield pa.record_batch([pa.array([at], pa.int64()), pa.array([held.tobytes()], pa.binary())], names=["slot", "map"])


def bucket_bits(n_bytes: int, min_count: int) -> int:
    """Bits of a bucket number: so many buckets that the n-grams of a corpus
    (about one a byte) fill one to a twelfth of ``min_count`` on average."""
    return min(40, max(RANGE_BITS, math.ceil(math.log2(max(1, n_bytes) * 12 / min_count + 1))))


def frequent_buckets(texts: DataFrame, bits: int, min_count: int) -> np.ndarray:
    """Bit array (at most 2^MOST_BITS bits) of the buckets that may hold a
    phrase found ``min_count`` times; numbers beyond are folded."""
    counted = texts.mapInArrow(bucket_counts(bits, min_count), "range long, data binary")
    maps = (counted.repartition("range").sortWithinPartitions("range")
            .mapInArrow(frequent_ranges(min_count), "slot long, map binary")
            .repartition("slot").sortWithinPartitions("slot").mapInArrow(merged_maps, "slot long, map binary"))
    out = np.zeros(1 << (min(bits, MOST_BITS) - 3), np.uint8)
    step = 1 << (RANGE_BITS - 3)
    for r in maps.toLocalIterator():     # at most 2^MOST_BITS bits in all
        out[r["slot"] * step:(r["slot"] + 1) * step] = np.frombuffer(r["map"], np.uint8)
    return out


# ---- second pass: phrases ---------------------------------------------------------
def block_phrases(block: Block, bits: int, maps: np.ndarray, keep_bits: int = 64) -> tuple[np.ndarray, ...]:
    """(first word's number, words, count, fingerprint) of the block's phrases
    in frequent buckets: aggregated by fingerprint, every occurrence compared
    with the one pointed at; occurrences that differ are counted by their words."""
    mask = np.uint64(len(maps) * 8 - 1)
    ns, where, prints = [np.empty(0, np.int8)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for n, at, f in block.fingerprints():
        b = (f >> np.uint64(64 - bits)) & mask
        on = np.flatnonzero(maps[b >> np.uint64(3)] & (np.uint8(128) >> (b & np.uint64(7)).astype(np.uint8)))
        ns.append(np.full(len(on), n, np.int8))
        where.append(at[on])
        prints.append(f[on] if keep_bits == 64 else f[on] >> np.uint64(64 - keep_bits))
    n, at, f = map(np.concatenate, (ns, where, prints))
    if not len(f):
        return at, n, at, f
    once, first, which, total = np.unique(f, return_index=True, return_inverse=True, return_counts=True)
    rep = first[which]
    same = (n == n[rep]) & (block.lang[at] == block.lang[at[rep]])
    for j in range(MAX_WORDS):
        i = np.flatnonzero(same & (n > j))
        same[i] = block.codes[at[i] + j] == block.codes[at[rep[i]] + j]
    odd = np.flatnonzero(~same)
    np.subtract.at(total, which[odd], 1)
    apart: Counter = Counter()
    seen: dict = {}
    for i in odd.tolist():
        key = (int(block.lang[at[i]]), tuple(block.codes[at[i]:at[i] + n[i]].tolist()))
        apart[key] += 1
        seen.setdefault(key, i)
    extra = np.array(list(seen.values()), np.int64)
    return (np.concatenate([at[first], at[extra]]), np.concatenate([n[first], n[extra]]),
            np.concatenate([total, np.array(list(apart.values()), np.int64)]), np.concatenate([once, f[extra]]))


HELD = 400_000               # phrases that a task counts before it sends them on
RANGE_BYTES = 64 << 20       # text for which the second pass has one range of fingerprints
KEYS, COLUMNS = ["lang", "phrase"], ["range", "lang", "phrase", "words", "f", "doc", "word"]


def phrase_table(keys: pa.ChunkedArray, block: Block, bits: int, maps: np.ndarray, ranges: int, keep_bits: int) -> pa.Table:
    """range (of the fingerprint), lang, phrase, words, f, doc, word of a block;
    words 0 is the number of all words of a language."""
    at, n, f, prints = block_phrases(block, bits, maps, keep_bits)
    every = np.bincount(block.lang, minlength=len(block.langs))
    some = np.flatnonzero(every)
    m = len(at)
    langs = pa.array(block.langs, pa.string()).take(pa.array(np.concatenate([block.lang[at], some])))
    return pa.table({
        "range": np.concatenate([(prints % np.uint64(ranges)).astype(np.int64), some % ranges]),
        "lang": langs, "phrase": pa.concat_arrays([block.phrases(at, n.astype(np.int64)), pa.array([b""] * len(some), pa.binary())]),
        "words": np.concatenate([n, np.zeros(len(some), np.int8)]).astype(np.int32),
        "f": np.concatenate([f, every[some]]).astype(np.int64),
        "doc": pa.concat_arrays([keys.combine_chunks().take(pa.array(block.doc[at])) if m else pa.array([], keys.type),
                                 pa.nulls(len(some), keys.type)]),
        "word": pa.concat_arrays([pa.array(block.at[at], pa.int32()), pa.nulls(len(some), pa.int32())])})


def combined(tables: list[pa.Table]) -> pa.Table:
    """One row a language and text: counts added, the first place kept."""
    t = pa.concat_tables(tables).group_by(KEYS, use_threads=False).aggregate(
        [("range", "first"), ("words", "first"), ("f", "sum"), ("doc", "first"), ("word", "first")])
    return t.rename_columns([c.removesuffix("_first").removesuffix("_sum") for c in t.column_names]).select(COLUMNS)


def packet(t: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, t.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as w:
        w.write_table(t)
    return out.getvalue().to_pybytes()


def phrase_packets(bits: int, maps, ranges: int, keep_bits: int):
    """mapInArrow body: (range, data) of a task's phrases in frequent buckets,
    dealt by fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, whole = [], 0, 0

        def sent() -> pa.RecordBatch:
            t = combined(held).sort_by([("range", "ascending"), ("phrase", "ascending")])
            r = t["range"].to_numpy()
            first = np.flatnonzero(np.diff(r, prepend=-1))
            data = [packet(t.slice(a, z - a)) for a, z in zip(first.tolist(), [*first[1:].tolist(), len(r)])]
            held.clear()
            return pa.record_batch([pa.array(r[first]), pa.array(data, pa.binary())], names=["range", "data"])

        for keys, block in blocks(batches):
            held.append(phrase_table(keys, block, bits, maps.value, ranges, keep_bits))
            del block
            rows += held[-1].num_rows
            if rows - whole >= HELD:
                held[:] = [combined(held)]
                rows = whole = held[0].num_rows
                if whole >= HELD:
                    yield sent()
                    rows = whole = 0
        if held:
            yield sent()
    return run


def phrase_sums(min_count: int):
    """mapInArrow body over packets sorted by range: (lang, words, phrase, f,
    doc, word) of the phrases counted ``min_count`` times; equal texts meet here
    whatever their fingerprints, the smallest place stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        at = None

        def out() -> Iterator[pa.RecordBatch]:
            t = combined([pa.concat_tables(held).sort_by([("doc", "ascending"), ("word", "ascending")])])
            held.clear()
            t = t.filter(pc.or_(pc.equal(t["words"], 0), pc.greater_equal(t["f"], min_count)))
            yield from t.select(["lang", "words", "phrase", "f", "doc", "word"]).combine_chunks().to_batches()

        for b in batches:
            for r, data in zip(b.column("range").to_pylist(), b.column("data")):
                if at is not None and r != at:
                    yield from out()
                at = r
                held.append(pa.ipc.open_stream(data.as_buffer()).read_all())
        if held:
            yield from out()
    return run


def phrase_counts(texts: DataFrame, bits: int, maps: np.ndarray, min_count: int, n_bytes: int, keep_bits: int = 64) -> DataFrame:
    """(lang, words, phrase, f, example): phrases counted ``min_count`` times in
    a language, and words 0: all words of the language (a row for each range
    that it was counted in)."""
    shared = texts.sparkSession.sparkContext.broadcast(maps)    # at most 2^MOST_BITS bits
    kind = texts.schema["key"].dataType.simpleString()
    packets = texts.mapInArrow(phrase_packets(bits, shared, max(64, n_bytes // RANGE_BYTES), keep_bits), "range long, data binary")
    return (packets.repartition("range").sortWithinPartitions("range")
            .mapInArrow(phrase_sums(min_count), f"lang string, words int, phrase binary, f long, doc {kind}, word int")
            .select("lang", "words", F.col("phrase").cast("string").alias("phrase"), "f",
                    F.when(F.col("words") > 0, F.struct("doc", "word")).alias("example")))


def frequent_phrases(docs: DataFrame, min_count: int, key: str = "doc_id", text: str = "text",
                     lang: str = "lang", keep_bits: int = 64) -> DataFrame:
    """(lang, words, phrase, f, example) of all phrases of 1 to MAX_WORDS words
    found at least ``min_count`` times in a language, and each language's number
    of words as words 0 (in parts to be added); example is one place (key, word number)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    n_bytes = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = bucket_bits(n_bytes, min_count)
    maps = frequent_buckets(texts, bits, min_count)
    return phrase_counts(texts, bits, maps, min_count, n_bytes, keep_bits)


def collocations(docs: DataFrame, min_count: int = 100, top: int | None = 2000, covered: int = 100,
                 key: str = "doc_id", text: str = "text", lang: str = "lang", keep_bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, example): phrases of 2 to 5
    words found a >= ``min_count`` times, by the score floor(1000 a n / (l r))
    of their weakest cut (ties to the first), without those inside a longer
    candidate that has at least ``covered`` per cent of their count; each
    language's ``top`` by score, count, phrase (None: all).

    A-Z count as a-z; pieces end at . , ; : ! ? and line ends, words at blanks
    and tabs.  A null text is empty, a null language is ``und``; every row
    counts, repeated ones too; columns beside key, text and lang play no part.
    No rows, or none with frequent phrases, give no rows.
    """
    freq = cut_lineage(frequent_phrases(docs, min_count, key, text, lang, keep_bits))
    part = freq.filter("words > 0")
    totals = freq.filter("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    cand = part.filter("words > 1")
    w = F.split("phrase", " ")
    cuts = (cand.select("lang", "phrase", F.col("f").alias("a"), F.posexplode(F.transform(
                F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
                    F.array_join(F.slice(w, 1, k), " ").alias("head"),
                    F.array_join(F.slice(w, k + 1, F.size(w) - k), " ").alias("tail")))).alias("k", "cut"))
            .select("lang", "phrase", "a", "k", "cut.head", "cut.tail"))
    base = cuts = cut_lineage(cuts)
    cuts = join_skewed(cuts, part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"], counted=base)
    cuts = join_skewed(cuts, part.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"], counted=base)
    cuts = join_skewed(cuts, totals, ["lang"], counted=base)
    whole = "CAST({} AS DECIMAL(19, 0))".format
    score = F.expr(f"({whole('1000')} * {whole('a')} * {whole('n')}) DIV ({whole('l')} * {whole('r')})")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("b"))
            .select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice(w, i, m), " "))))
    inside = (cand.filter("words > 2").select("lang", "f", F.explode(F.array_distinct(inner)).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))
    left = (best.join(inside, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(covered) * F.col("a"))).drop("longer")
            .join(cand.select("lang", "phrase", "example"), ["lang", "phrase"]))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "example")
