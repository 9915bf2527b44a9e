"""Many sparse linear classifiers trained together (T11, T12, E8 for text).

A *model* is one class of one setting on one fold's training rows; all models
of a fit share every pass.  Documents are numbered in parts once; their entries
are dealt to blocks by term once, packed by part and run of terms, and stay
there.  So a block knows all it needs of its terms: document frequencies,
idf and weights, which are sums over its own entries and are never moved.  An
iteration ships each block the documents' steps (a byte a document and model:
how often it was within the margin), and each part the margins that the blocks
add up to; what moves grows with the documents, not with terms or entries.
A block is read as a stream, run by run, so blocks need not be small, and a task may read several and add up their margins: a pass over many
models is cut by models (:func:`groups`) rather than by terms alone, since every
task that has terms of its own sends margins of all documents.
Nothing of the vocabulary's or the corpus's size reaches the driver.

With steps 1 / (alpha (t + 1 / alpha)) from zero, t steps give the weights
sum y k x / (m (alpha t + 1)), k a document's steps within the margin: the
whole state of a fit is k, and an intercept a model.

Settings that differ in n-gram range or idf use the same counts: a *view* is a
way to weigh them (range, idf, fold)."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType

from keelson.operators.lookup import BLOCK_ENTRIES, FEW_IDS, SEP, joined
from keelson.session import cut_lineage, cut_partitioned, numbers, release

# Entries of a block of terms (sorted when it is written), and of a run of terms,
# which is worked on at once, about.
TERM_ENTRIES = 100_000_000
SLICE = 1_000_000
# Models whose sums are held at once.
CHUNK = 16


@dataclass(frozen=True)
class Setting:
    """Words of ``low`` to ``high`` per term, tf-idf or counts, unit rows or
    as they are, and the penalty's weight."""
    low: int = 1
    high: int = 1
    use_idf: bool = True
    normalise: bool = True
    alpha: float = 1e-3


@dataclass(frozen=True)
class View:
    low: int
    high: int
    use_idf: bool
    normalise: bool
    fold: int          # left out of training; -1: none


@dataclass(frozen=True)
class Model:
    setting: int
    view: int
    positive: int      # number of the class
    alpha: float


@dataclass
class Posted:
    """``docs`` (part, id, y, fold), ``posts`` (block, run, part, terms, size, at, n):
    the terms of a run that a part has, as one text, how often each is there, their
    positions in the part and their numbers (see :func:`pack`); a document's
    position is its id's rank in the part.  ``sizes``: documents of each part;
    ``blocks``: the blocks' numbers, each in a partition of its own.  Without
    labels there are no ``docs``."""
    docs: DataFrame | None
    posts: DataFrame
    sizes: dict
    blocks: list
    id_col: str


@dataclass
class ManyModels:
    settings: list
    classes: list
    views: list
    models: list
    posted: Posted
    state: DataFrame       # part, y, fold, norm, k (arrays as bytes)
    held: dict             # documents of each fold
    min_df: int
    bias: np.ndarray
    loss: np.ndarray
    norm2: np.ndarray      # |w|^2 at the weights before the last step
    steps: int = 0
    t0: float | None = None    # None: 1 / alpha

    @property
    def id_col(self) -> str:
        return self.posted.id_col

    def train_sizes(self) -> np.ndarray:
        """Training documents of every model."""
        folds = [self.views[m.view].fold for m in self.models]
        return np.array([sum(n for f, n in self.held.items() if v < 0 or f != v) for v in folds], float)

    def losses(self) -> np.ndarray:
        """Mean hinge loss of every model at the weights before the last step."""
        return self.loss

    def weights(self) -> DataFrame:
        """(term, idf, w): a list of all views, and one of all models."""
        def run(many: ManyModels, b: Documents) -> Iterator[pa.Table]:
            for s in b.slices():
                w = np.zeros((len(s.terms), len(many.models)))
                for _, mine, x, at in s.features(b, many):
                    for j in mine:
                        w[:, j] = np.bincount(s.term[at], x * b.coefficients(many, j)[s.doc[at]], len(s.terms))
                on = np.flatnonzero(s.df.sum(axis=1) >= many.min_df)
                yield pa.table({"term": s.terms.take(pa.array(on)), "idf": list_of(s.idf(many)[on]), "w": list_of(w[on])})
        return passed(self, run, "term string, idf array<double>, w array<double>")

    def table(self) -> DataFrame:
        """(setting, fold, class, term, weight); the intercept has a null term."""
        meta = F.array(*[F.struct(F.lit(m.setting).alias("setting"), F.lit(self.views[m.view].fold).alias("fold"),
                                  F.lit(self.classes[m.positive]).alias("class")) for m in self.models])
        bias = self.state.sparkSession.createDataFrame([(None, [float(b) for b in self.bias])], "term string, w array<double>")
        return (self.weights().select("term", "w").unionByName(bias)
                .select("term", F.posexplode("w").alias("m", "weight"))
                .select(F.element_at(meta, F.col("m") + 1).alias("_m"), "term", "weight")
                .select("_m.setting", "_m.fold", "_m.class", "term", "weight"))


def labelled(labels: DataFrame, id_col: str, label: str, fold: str | None) -> DataFrame:
    """(id, label, fold): one label an id (the smallest); rows without id or
    label are left out."""
    f = F.lit(-1) if fold is None else F.col(fold).cast("int")
    return (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
            .groupBy(id_col).agg(F.min(F.struct(F.col(label).alias("label"), f.alias("fold"))).alias("_l"))
            .select(id_col, "_l.label", "_l.fold"))


def whole(column):
    c = column.combine_chunks()
    return pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c


def lists(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, lengths) of a list column."""
    c = whole(column)
    size = np.diff(np.asarray(c.offsets))
    return c.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False), size


def list_of(a: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    ends = pa.array(np.arange(a.shape[0] + 1, dtype=np.int32) * np.int32(a.shape[1]))
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(a).ravel()))


def square(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return lists(column, np.float64)[0].reshape(len(column), width)


def by_row(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``size`` rows; empty runs give 0."""
    out = np.zeros((len(size), *values.shape[1:]))
    some = size > 0
    if some.any():
        start = np.concatenate([[0], np.cumsum(size[some])[:-1]])
        out[some] = np.add.reduceat(values, start, axis=0)
    return out


def post(rows: DataFrame, labels: DataFrame | None, id_col: str, entries: int | None = None, held: bool = False) -> Posted:
    """Entries by term.  ``rows``: (id, terms, n), lists, one row an id at most, or
    (id, term, n); ``labels`` (id, y, fold), one row an id: the documents, with or
    without entries (none given: all ids, see :func:`post_all`).  Terms are not
    empty and hold no newline; ``entries``: about how many there are, counted if
    not given.  With ``held`` only ids with entries are documents."""
    spark = rows.sparkSession
    slots = spark.sparkContext.defaultParallelism
    if not isinstance(rows.schema["n"].dataType, ArrayType):
        pairs = F.collect_list(F.struct("term", "n"))
        rows = (rows.filter(F.col(id_col).isNotNull() & F.col("term").isNotNull()).groupBy(id_col).agg(pairs.alias("_e"))
                .select(id_col, F.col("_e.term").alias("terms"), F.col("_e.n").alias("n")))
    first = None
    if entries is None:
        first = rows = cut_lineage(rows)
        entries = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    whole_n = isinstance(rows.schema["n"].dataType.elementType, IntegralType)
    n_kind = "int" if whole_n else "double"
    rows = rows.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), joined().alias("terms"), F.col("n").cast(f"array<{n_kind}>").alias("n"))
    kind = rows.schema["id"].dataType.simpleString()
    blocks = numbers(spark, max(slots, -(-entries // TERM_ENTRIES)))
    runs = max(1, -(-entries // (len(blocks) * SLICE)))
    if labels is None:
        posted = post_all(rows, blocks, runs, id_col, whole_n)
        if first is not None:
            release(first)
        return posted
    lab = labels.select(F.col(id_col).alias("id"), "y", "fold")
    few = lab.count() <= FEW_IDS
    rows = rows.join(F.broadcast(lab.select("id")), "id", "left_semi") if few else rows
    rows = rows.unionByName(lab, allowMissingColumns=True)
    parts = max(slots, -(-entries // BLOCK_ENTRIES))
    rows = cut_partitioned(rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")), parts, "part")
    docs = rows.groupBy("part", "id").agg(F.max("y").alias("y"), F.max("fold").alias("fold"), F.max("terms").alias("terms")).filter("y IS NOT NULL")
    docs = cut_partitioned((docs.filter("terms != ''") if held else docs).drop("terms"), parts, "part")
    sizes = {r["part"]: r["n"] for r in docs.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}

    def turned(key, t):
        """A part's entries by term."""
        ids = in_order(t.filter(pc.is_valid(t["y"])))["id"]
        t = t.filter(pc.is_valid(t["terms"]))
        if held:
            ids = ids.filter(pc.is_in(ids, value_set=whole(t.filter(pc.not_equal(t["terms"], ""))["id"])))
        place = pc.index_in(whole(t["id"]), value_set=whole(ids))
        t = t.filter(pc.is_valid(place))
        return by_term(t, place.drop_null().to_numpy(zero_copy_only=False), key[0].as_py(), whole_n, blocks, runs)

    posts = rows.select("part", "id", "terms", "n", "y").groupBy("part").applyInArrow(turned, POSTS)
    posts = cut_partitioned(posts, len(blocks), "block", order=["run"])
    release(rows)
    if first is not None:
        release(first)
    return Posted(docs.select("part", F.col("id").cast(kind).alias(id_col), "y", "fold"), posts, sizes, blocks, id_col)


POSTS = "block int, run int, part int, terms string, size binary, at binary, n binary"


def pack(a: np.ndarray) -> bytes:
    """Numbers of eight bytes, whole ones of one, two or four as the largest needs."""
    if a.dtype.kind == "f":
        return a.astype(np.float64).tobytes()
    low, high = (int(a.min()), int(a.max())) if len(a) else (0, 0)
    return a.astype(np.uint8 if 0 <= low and high < 1 << 8 else np.uint16 if 0 <= low and high < 1 << 16 else np.int32).tobytes()


def unpack(data: bytes, count: int) -> np.ndarray:
    """What :func:`pack` made of ``count`` numbers."""
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.int32, 8: np.float64}[len(data) // count] if count else np.uint8)


def by_term(t: pa.Table, place: np.ndarray, part: int, whole_n: bool, blocks: list, runs: int) -> pa.Table:
    """The entries of rows (terms, n) at ``place`` in a part, by block and run of terms."""
    text = whole(t["terms"])
    some = pc.greater(pc.binary_length(text), 0)
    terms = pc.split_pattern(text.filter(some), SEP)
    size = np.zeros(len(text), np.int64)
    size[some.to_numpy(zero_copy_only=False)] = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    n = lists(t["n"], np.int32 if whole_n else np.float64)[0]
    codes = whole(pa.chunked_array([terms.flatten().dictionary_encode()]))
    words = codes.dictionary.to_numpy(zero_copy_only=False).astype(object)
    run = (pd.util.hash_array(words, categorize=False) % np.uint64(len(blocks) * runs)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    by_run = np.argsort(run, kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[by_run] = np.arange(len(words))
    code, at = rank[codes.indices.to_numpy(zero_copy_only=False)], np.repeat(place, size)
    order = np.argsort(code, kind="stable")
    at, n, words, run = at[order], n[order], words[by_run], run[by_run]
    per = np.bincount(code, minlength=len(words))
    ends = np.concatenate([[0], np.cumsum(per)])
    cut = np.flatnonzero(np.diff(run, prepend=-1)).tolist()
    out: list = [[] for _ in range(7)]
    for a, z in zip(cut, [*cut[1:], len(words)]):
        e = slice(ends[a], ends[z])
        row = (blocks[run[a] % len(blocks)], int(run[a] // len(blocks)), part, SEP.join(words[a:z]), pack(per[a:z]), pack(at[e]), pack(n[e]))
        for column, v in zip(out, row):
            column.append(v)
    kinds = [pa.int32()] * 3 + [pa.string()] + [pa.binary()] * 3
    return pa.table({c.split()[0]: pa.array(v, kind) for c, v, kind in zip(POSTS.split(", "), out, kinds)})


# Parts that a task makes at most.
TASK_PARTS = 1 << 12


def post_all(rows: DataFrame, blocks: list, runs: int, id_col: str, whole_n: bool) -> Posted:
    """:func:`post` of all ids, without labels.  A part is a run of rows, in order
    of ids, where they are: only their entries are shuffled, by term."""
    limit = BLOCK_ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, waiting, size = TaskContext.get().partitionId() * TASK_PARTS, [], 0
        end = part + TASK_PARTS

        def made():
            t = pa.concat_tables(waiting)
            found = by_term(t, np.arange(t.num_rows), part, whole_n, blocks, runs)
            # one row without terms has the number of the part's documents
            told = pa.table({f.name: pa.array([{"block": blocks[0], "part": part}.get(f.name)], f.type) for f in found.schema})
            docs = pa.array([None] * found.num_rows + [t.num_rows], pa.int32())
            yield from pa.concat_tables([found, told]).append_column("docs", docs).to_batches()

        for b in batches:
            t = pa.Table.from_batches([b])
            if t.num_rows:
                waiting.append(t)
                size += pc.sum(pc.list_value_length(t["n"])).as_py() or 0
            if size >= limit:
                if part == end:
                    raise RuntimeError("too many rows in a task")
                yield from made()
                part, waiting, size = part + 1, [], 0
        if waiting:
            yield from made()

    posts = rows.sortWithinPartitions("id").select("terms", "n").mapInArrow(run, POSTS + ", docs int")
    posts = cut_partitioned(posts, len(blocks), "block", order=["run"])
    sizes = {r["part"]: r["docs"] for r in posts.filter("docs IS NOT NULL").select("part", "docs").collect()}
    return Posted(None, posts.filter("docs IS NULL").drop("docs"), sizes, blocks, id_col)


def in_order(docs: pa.Table, id_col: str = "id") -> pa.Table:
    return docs.take(pc.sort_indices(docs, sort_keys=[(id_col, "ascending")]))


class Slice:
    """A run of terms with all their entries.  ``rows`` has what was read; ``code``:
    the numbers of all terms there, one after the other."""

    def __init__(self, terms: pa.Array, term: np.ndarray, doc: np.ndarray, n: np.ndarray, rows: pa.Table, code: np.ndarray):
        self.terms, self.term, self.doc, self.n, self.rows, self.code = terms, term, doc, n, rows, code
        self.df = None

    def count(self, fold: np.ndarray, folds: int) -> None:
        at = self.term * (folds + 1) + fold[self.doc] + 1
        self.df = np.bincount(at, minlength=len(self.terms) * (folds + 1)).reshape(-1, folds + 1)

    def idf(self, many: ManyModels) -> np.ndarray:
        """(terms, views): 0 for a term that a view doesn't use."""
        every, total = self.df.sum(axis=1), sum(many.held.values())
        long = pc.add(pc.count_substring(self.terms, " "), 1).to_numpy(zero_copy_only=False)
        out = np.zeros((len(self.terms), len(many.views)))
        for i, v in enumerate(many.views):
            df = every - self.df[:, v.fold + 1] if v.fold >= 0 else every
            m = total - (many.held.get(v.fold, 0) if v.fold >= 0 else 0)
            w = np.log((1.0 + m) / (1.0 + df)) + 1.0 if v.use_idf else 1.0
            out[:, i] = np.where((long >= v.low) & (long <= v.high) & (df >= many.min_df) & (every >= many.min_df), w, 0.0)
        return out

    def features(self, b: Documents, many: ManyModels, norms: bool = True):
        """(view, numbers of its models, values, their places) of each view."""
        idf = self.idf(many)
        for i, v in enumerate(many.views):
            w = idf[:, i]
            at = np.flatnonzero(w[self.term] != 0) if (w == 0).any() else slice(None)
            x = self.n[at] * w[self.term[at]]
            if v.normalise and norms:
                x = x / b.norm[i][self.doc[at]]
            yield i, [j for j, m in enumerate(many.models) if m.view == i], x, at


def steps_of(many: ManyModels, j: int, y: np.ndarray, k: np.ndarray) -> np.ndarray:
    m = many.models[j]
    scale = 1.0 / (max(1.0, many.train_sizes()[j]) * m.alpha * (many.steps + (1.0 / m.alpha if many.t0 is None else many.t0)))
    return np.where(y == m.positive, scale, -scale) * k


class Block:
    """The terms of one block, or of several, as they come, and all documents.
    Rows without a term tell of the documents of a part (``take``); a block's
    come before its terms."""

    take: Callable | None = None

    def __init__(self, batches: Iterator[pa.RecordBatch], sizes: dict):
        self.batches, self.sizes = batches, sizes
        self.parts = sorted(sizes)
        first = np.cumsum([0] + [sizes[p] for p in self.parts])[:-1]
        self.start = dict(zip(self.parts, first.tolist()))
        self.m = sum(sizes.values())
        self.met: set = set()
        self.seen = False        # any term

    def posts(self) -> Iterator[pa.Table]:
        for b in self.batches:
            t = pa.Table.from_batches([b])
            told = pc.is_null(t["terms"])
            if self.take is not None and pc.any(told).as_py():
                about = t.filter(told)
                self.take(about)
                self.met.update(about["part"].to_pylist())
                t = t.filter(pc.invert(told))
            if t.num_rows:
                if self.take is not None and len(self.met) < len(self.sizes):
                    raise RuntimeError("the terms of a block came without its documents")
                self.seen = True
                yield t

    def slices(self) -> Iterator[Slice]:
        waiting, held = [], None
        for t in self.posts():
            block, run = t["block"].to_numpy(), t["run"].to_numpy()
            cut = (np.flatnonzero((np.diff(block) != 0) | (np.diff(run) != 0)) + 1).tolist()
            for a, z in zip([0, *cut], [*cut, len(run)]):
                if waiting and held != (block[a], run[a]):
                    yield self.slice(pa.concat_tables(waiting))
                    waiting = []
                waiting.append(t.slice(a, z - a))
                held = block[a], run[a]
        if waiting:
            yield self.slice(pa.concat_tables(waiting))

    def slice(self, t: pa.Table) -> Slice:
        terms = pc.split_pattern(whole(t["terms"]), SEP)
        codes = terms.flatten().dictionary_encode()
        code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        size, doc, n = [], [], []
        for p, count, r in zip(t["part"].to_pylist(), pc.list_value_length(terms).to_pylist(), t.select(["size", "at", "n"]).to_pylist()):
            size.append(unpack(r["size"], count))
            entries = int(size[-1].sum())
            doc.append(unpack(r["at"], entries) + np.int64(self.start[p]))
            n.append(unpack(r["n"], entries).astype(np.float64))
        return Slice(codes.dictionary, np.repeat(code, np.concatenate(size)), np.concatenate(doc), np.concatenate(n), t, code)

    def by_part(self, sums: np.ndarray) -> pa.Table:
        """(part, v): the columns of a part's documents as bytes."""
        v = [np.ascontiguousarray(sums[:, self.start[p]:self.start[p] + self.sizes[p]]).tobytes() for p in self.parts]
        return pa.table({"part": pa.array(self.parts, pa.int32()), "v": pa.array(v, pa.binary())})


class Documents(Block):
    """With all documents' y, fold, norms and steps."""

    def __init__(self, batches: Iterator[pa.RecordBatch], sizes: dict, views: int, models: int, folds: int, kind):
        super().__init__(batches, sizes)
        self.folds, self.kind = folds, kind
        self.y, self.fold = np.zeros(self.m, np.int32), np.full(self.m, -1, np.int32)
        self.norm, self.k = np.ones((views, self.m)), np.zeros((models, self.m), kind)

    def take(self, about: pa.Table) -> None:
        for r in about.select(STATE_NAMES).to_pylist():
            a = self.start[r["part"]]
            z = a + self.sizes[r["part"]]
            self.y[a:z], self.fold[a:z] = np.frombuffer(r["y"], np.int32), np.frombuffer(r["fold"], np.int32)
            if r["norm"]:
                norm = np.frombuffer(r["norm"], np.float64).reshape(len(self.norm), -1)
                self.norm[:, a:z] = np.where(norm == 0, 1.0, norm)
            if r["k"]:
                self.k[:, a:z] = np.frombuffer(r["k"], self.kind).reshape(len(self.k), -1)

    def slice(self, t: pa.Table) -> Slice:
        s = super().slice(t)
        s.count(self.fold, self.folds)
        return s

    def coefficients(self, many: ManyModels, j: int) -> np.ndarray:
        """The weights of model ``j`` are these times the documents' features."""
        return steps_of(many, j, self.y, self.k[j])


def routed(docs: DataFrame, blocks: list) -> DataFrame:
    """The rows of the parts, for every block of terms."""
    return docs.withColumn("block", F.explode(F.array(*map(F.lit, blocks))))


def streamed(posted: Posted, docs: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
             tasks: int | None = None) -> DataFrame:
    """``run`` over every block: the rows of ``docs`` (part, ..) and then the terms
    that are there already, one partition after the other in ``tasks`` tasks (none
    given: a task a block).  The union keeps both sides' partitions together and
    in this order (spark.sql.unionOutputPartitioning); :class:`Block` fails if not."""
    rows = (routed(docs, posted.blocks).repartition(len(posted.blocks), "block")
            .unionByName(posted.posts, allowMissingColumns=True))
    tasks = min(tasks or len(posted.blocks), len(posted.blocks))
    if tasks < len(posted.blocks) or tasks == 1:
        rows = rows.coalesce(tasks)
    return rows.mapInArrow(run, schema)


def passed(many: ManyModels, body: Callable[[ManyModels, Documents], Iterator[pa.Table]], schema: str,
           mine: Sequence[int] | None = None, tasks: int | None = None) -> DataFrame:
    """``body`` over every block of terms (see :func:`streamed`), which gets the
    documents' state; ``mine``: of these models and their views alone."""
    at = sorted({many.models[j].view for j in mine}) if mine else list(range(len(many.views)))
    mine = list(range(len(many.models))) if mine is None else list(mine)
    sizes, n_views, n_models = many.posted.sizes, len(many.views), len(many.models)
    folds = max([v.fold for v in many.views] + list(many.held) + [-1]) + 1
    slim = dataclasses.replace(many, posted=None, state=None, views=[many.views[v] for v in at],
                               models=[dataclasses.replace(many.models[j], view=at.index(many.models[j].view)) for j in mine])
    kind = np.uint8 if many.steps < 256 else np.uint16

    def picked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                norm = np.frombuffer(r["norm"], np.float64).reshape(n_views, -1)[at].tobytes() if r["norm"] else None
                k = np.frombuffer(r["k"], np.uint16).reshape(n_models, -1)[mine].astype(kind).tobytes() if r["k"] else None
                yield pa.record_batch([pa.array([r["part"]], pa.int32()), *[pa.array([x], pa.binary()) for x in (r["y"], r["fold"], norm, k)]],
                                      names=STATE_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = Documents(batches, sizes, len(at), len(mine), folds, kind)
        for t in body(slim, b):
            if b.seen:
                yield from t.to_batches()

    return streamed(many.posted, many.state.select(STATE_NAMES).mapInArrow(picked, STATE), run, schema, tasks)


def slots_of(many: ManyModels) -> int:
    return many.state.sparkSession.sparkContext.defaultParallelism


def groups(many: ManyModels) -> list:
    """The models in groups, those of a view together, for the tasks of a pass: as
    many as there are views, up to half the task slots."""
    n = max(1, min(len(many.views), -(-slots_of(many) // 2)))
    return [[j for j, m in enumerate(many.models) if m.view % n == i] for i in range(n)]


def shared(many: ManyModels, of: list | None = None) -> DataFrame:
    """(part, v, g): shares of the margins of each group of models, a row a part
    and task."""
    of = of or groups(many)
    tasks = -(-slots_of(many) // len(of))
    return functools.reduce(DataFrame.unionByName, [passed(many, margins, "part int, v binary", g, tasks).withColumn("g", F.lit(i))
                                                    for i, g in enumerate(of)])


def squares(many: ManyModels, b: Documents) -> Iterator[pa.Table]:
    """Sums of squared features by view, of each document."""
    out = np.zeros((len(many.views), b.m))
    for s in b.slices():
        for v, _, x, at in s.features(b, many, norms=False):
            out[v] += np.bincount(s.doc[at], x * x, b.m)
    yield b.by_part(out)


def margins(many: ManyModels, b: Documents) -> Iterator[pa.Table]:
    """The block's share of every document's margins, without the intercept."""
    held = np.zeros((len(many.models), b.m))
    for s in b.slices():
        for _, mine, x, at in s.features(b, many):
            term, doc = s.term[at], s.doc[at]
            for j in mine:
                w = np.bincount(term, x * b.coefficients(many, j)[doc], len(s.terms))
                held[j] += np.bincount(doc, x * w[term], b.m)
    yield b.by_part(held)


def added(shares: pa.Table, rows: int, m: int, of: Sequence[Sequence[int]] | None = None) -> np.ndarray:
    """The sum of the tasks' shares of a part; ``of``: the rows of each group."""
    out = np.zeros((rows, m))
    for i, v in enumerate(whole(shares["v"]) if shares.num_rows else ()):
        mine = slice(None) if of is None else of[shares["g"][i].as_py()]
        out[mine] += np.frombuffer(v.as_buffer(), np.float64).reshape(-1, m)
    return out


def prepare(counts: DataFrame, labels: DataFrame | None, settings: Sequence[Setting], folds: int = 0, classes: Sequence | None = None,
            id_col: str = "doc_id", term: str = "term", n: str = "n", label: str = "label", fold: str | None = None,
            min_df: int = 1, entries: int | None = None, with_entries: bool = False) -> ManyModels:
    """Documents in parts, entries in blocks of terms, and weights of zero.
    ``counts``: (id, term, n) rows, or (id, terms, n) lists (see :func:`post`).
    Documents with a label but without terms count (their margin is the
    intercept); a term in fewer than ``min_df`` of a model's training documents
    has no weight there.  With ``with_entries`` documents without terms don't count."""
    lab = cut_lineage(labelled(labels, id_col, label, fold if folds else None))
    if classes is None:
        classes = sorted(r[0] for r in lab.select("label").distinct().collect())
    classes, settings = list(classes), list(settings)
    number = F.coalesce(*[F.when(F.col("label") == F.lit(c), F.lit(i)) for i, c in enumerate(classes)], F.lit(-1))
    lab = lab.select(id_col, number.alias("y"), F.coalesce("fold", F.lit(-1)).alias("fold"))
    used = range(folds) if folds else [-1]
    views = list(dict.fromkeys(View(s.low, s.high, s.use_idf, s.normalise, f) for s in settings for f in used))
    positives = range(1 if len(classes) == 2 else 0, len(classes))
    models = [Model(i, views.index(View(s.low, s.high, s.use_idf, s.normalise, f)), c, s.alpha)
              for i, s in enumerate(settings) for f in used for c in positives]
    rows = counts.select(id_col, "terms", "n") if "terms" in counts.columns else counts.select(id_col, F.col(term).alias("term"), F.col(n).alias("n"))
    posted = post(rows, lab, id_col, entries, with_entries)
    held = {r["fold"]: r["n"] for r in posted.docs.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = max(1, posted.docs.rdd.getNumPartitions())

    def begun(key, t):
        t = in_order(t, id_col)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "y": [t["y"].to_numpy().astype(np.int32).tobytes()],
                         "fold": [t["fold"].to_numpy().astype(np.int32).tobytes()], "norm": pa.array([None], pa.binary()),
                         "k": pa.array([None], pa.binary())})

    state = cut_partitioned(posted.docs.groupBy("part").applyInArrow(begun, STATE), parts, "part")
    zero = np.zeros(len(models))
    many = ManyModels(settings, classes, views, models, posted, state, held, min_df, zero, np.full(len(models), np.nan), zero)
    if not models or not any(v.normalise for v in views):
        return many
    n_views = len(views)

    def normed(docs: pa.Table, shares: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return docs.select(STATE_NAMES)
        norm = np.sqrt(added(shares, n_views, len(docs["y"][0].as_py()) // 4))
        return docs.select(STATE_NAMES).set_column(3, "norm", pa.array([norm.tobytes()], pa.binary()))

    shares = passed(many, squares, "part int, v binary", tasks=slots_of(many))
    new = many.state.groupBy("part").cogroup(shares.groupBy("part")).applyInArrow(normed, STATE)
    return dataclasses.replace(many, state=cut_partitioned(new, parts, "part"))


STATE = "part int, y binary, fold binary, norm binary, k binary"
STATE_NAMES = ["part", "y", "fold", "norm", "k"]


def stepped(many: ManyModels, of: list):
    """Cogroup body over a part: its margins (of the groups ``of``), and one step
    more for each document and model where the hinge has a slope."""
    n_models = len(many.models)
    many = dataclasses.replace(many, posted=None, state=None)

    def run(docs: pa.Table, shares: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return docs.select(STATE_NAMES).append_column("sums", pa.array([], pa.list_(pa.float64())))
        y, fold = (np.frombuffer(docs[c][0].as_py(), np.int32) for c in ("y", "fold"))
        m, k = added(shares, n_models, len(y), of), docs["k"][0].as_py()
        k = np.frombuffer(k, np.uint16).reshape(n_models, -1).copy() if k else np.zeros((n_models, len(y)), np.uint16)
        sums = np.zeros((3, n_models))       # subgradients of the intercepts, losses, |w|^2
        for j, model in enumerate(many.models):
            sign = np.where(y == model.positive, 1.0, -1.0)
            slack = 1.0 - sign * (m[j] + many.bias[j])
            on = slack > 0
            if many.views[model.view].fold >= 0:
                on &= fold != many.views[model.view].fold
            sums[:, j] = -sign[on].sum(), slack[on].sum(), (steps_of(many, j, y, k[j]) * m[j]).sum()
            k[j] += on
        return (docs.select(STATE_NAMES).set_column(4, "k", pa.array([k.tobytes()], pa.binary()))
                .append_column("sums", pa.array([sums.ravel().tolist()], pa.list_(pa.float64()))))
    return run


def fit(many: ManyModels, iters: int = 10, start: int = 0) -> ManyModels:
    """``iters`` more full-batch steps of all models at once, from zero weights
    or from where ``start`` earlier steps ended: minimises
    alpha/2 |w|^2 + mean hinge, step 1 / (alpha (t + 1/alpha)).  A step moves the
    documents' steps to the blocks of terms and their margins back, never an
    entry or a weight."""
    if start != many.steps:
        raise ValueError(f"{many.steps} steps were taken, not {start}")
    if start + iters > np.iinfo(np.uint16).max:
        raise ValueError("too many steps")
    models = many.models
    if not models:
        return many
    sizes, alphas = many.train_sizes(), np.array([m.alpha for m in models])
    n_models, parts = len(models), max(1, many.state.rdd.getNumPartitions())
    of, written = groups(many), None
    for _ in range(iters):
        shares = shared(many, of)
        if not many.steps:
            shares = shares.limit(0)         # all margins are zero
        new = many.state.groupBy("part").cogroup(shares.groupBy("part")).applyInArrow(stepped(many, of), STATE + ", sums array<double>")
        new = cut_partitioned(new, parts, "part")
        if written is not None:
            release(written)
        written = new
        sums = np.zeros((3, n_models))
        for r in new.select("sums").toLocalIterator():
            sums += np.array(r["sums"]).reshape(3, n_models)
        t = many.steps + 1
        rates = 1.0 / (alphas * (t + (1.0 / alphas if many.t0 is None else many.t0)))
        mean = sums / np.maximum(sizes, 1)
        many = dataclasses.replace(many, state=new.select(*STATE_NAMES), bias=many.bias - rates * mean[0], loss=mean[1], norm2=sums[2], steps=t)
    return many


def scores(many: ManyModels, held_out: bool = False) -> DataFrame:
    """(id, setting, fold, y, scores, loss): every document's margins in the
    order of ``positives``; with ``held_out`` only by the models of the
    document's own fold, which didn't train on it.  Two classes have one margin
    (of the second class)."""
    views, n_models, id_col, bias = many.views, len(many.models), many.id_col, many.bias
    docs, of = many.posted.docs, groups(many)
    kind = docs.schema[id_col].dataType.simpleString()
    fitted: dict = {}
    for i, m in enumerate(many.models):
        fitted.setdefault((m.setting, m.view), []).append(i)

    def run(docs: pa.Table, shares: pa.Table) -> pa.Table:
        made = []
        if docs.num_rows:
            docs = in_order(docs, id_col)
            y, fold = docs["y"].to_numpy().astype(np.int32), docs["fold"].to_numpy()
            m = added(shares, n_models, len(y), of) + bias[:, None]
            for (setting, v), mine in fitted.items():
                rows = np.flatnonzero(fold == views[v].fold) if held_out else np.arange(len(y))
                made.append(pa.table({
                    id_col: docs[id_col].take(pa.array(rows)), "setting": pa.array(np.full(len(rows), setting, np.int32)),
                    "fold": pa.array(np.full(len(rows), views[v].fold, np.int32)), "y": pa.array(y[rows]),
                    "scores": list_of(m[mine][:, rows].T)}))
        if made:
            return pa.concat_tables(made)
        return pa.table({id_col: docs[id_col].slice(0, 0), "setting": pa.array([], pa.int32()), "fold": pa.array([], pa.int32()),
                         "y": pa.array([], pa.int32()), "scores": pa.array([], pa.list_(pa.float64()))})

    return (docs.groupBy("part").cogroup(shared(many, of).groupBy("part"))
            .applyInArrow(run, f"`{id_col}` {kind}, setting int, fold int, y int, scores array<double>"))


def predictions(many: ManyModels, held_out: bool = False) -> DataFrame:
    """(id, setting, fold, truth, pred, score): the class of the greatest margin
    (first wins); of two classes the second at a margin of at least 0."""
    s = scores(many, held_out)
    names = F.array(*[F.lit(c) for c in many.classes])
    if len(many.classes) == 2:
        score = F.col("scores")[0]
        pred = F.when(score >= 0, F.lit(2)).otherwise(F.lit(1))
    else:
        score = F.array_max("scores")
        pred = F.array_position("scores", score).cast("int")
    return s.select(many.id_col, "setting", "fold", F.when(F.col("y") >= 0, F.element_at(names, F.col("y") + 1)).alias("truth"),
                    F.element_at(names, pred).alias("pred"), score.alias("score"))


def grid(many: ManyModels) -> DataFrame:
    """One row a setting: setting, its parameters, n, accuracy of the
    held-out predictions, and whether it is the best (ties to the first)."""
    p = predictions(many, held_out=True)
    acc = p.groupBy("setting").agg(F.count(F.lit(1)).alias("n"),
                                   F.avg(F.coalesce((F.col("pred") == F.col("truth")).cast("double"), F.lit(0.0))).alias("accuracy"))
    rows = [(i, s.low, s.high, s.use_idf, float(s.alpha)) for i, s in enumerate(many.settings)]
    names = many.state.sparkSession.createDataFrame(rows, "setting int, low int, high int, use_idf boolean, alpha double")
    acc = cut_lineage(names.join(acc, "setting", "left"))
    best = acc.orderBy(F.desc_nulls_last("accuracy"), "setting").first()
    return acc.withColumn("best", F.col("setting") == F.lit(best["setting"] if best else -1))
