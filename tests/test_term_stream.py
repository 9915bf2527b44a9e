"""Blocks of terms are read as streams: their number, what a pass moves and what
stays on disk don't grow with terms, entries or passes."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.operators import many_sparse as MS
from keelson.operators import pca as PC
from keelson.operators import text as TX
from tests.test_many_sparse import corpus


def frames(spark, n=30):
    docs = spark.createDataFrame([r for r in corpus(n) if r[3] is not None], "doc_id long, text string, label string, f int")
    return TX.count_lists(docs, "doc_id", "text", 1, 2), docs.select("doc_id", "label", "f")


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {x for x in (blocks.apply(i).toString() for i in range(blocks.size())) if x.startswith("shuffle_")}


def written(spark):
    """Folders of checkpoints."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    return {f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}


def weights(many):
    return {(r["setting"], r["fold"], r["class"], r["term"]): r["weight"] for r in many.table().collect()}


def test_components_write_no_table_by_term_in_a_pass(spark):
    rng = np.random.default_rng(8)
    X = np.where(rng.random((90, 25)) < 0.3, rng.random((90, 25)), 0.0) + np.outer(rng.random(90), np.arange(25) > 18)
    names = ["t%d" % j if j % 3 else "té %d" % j for j in range(25)]
    rows = [(i, [names[j] for j in np.flatnonzero(X[i])], [float(v) for v in X[i][X[i] != 0]]) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, terms array<string>, w array<double>").repartition(3)
    folders = written(spark)
    got = PC.sparse_subspace(df, 2, iters=4, entries=len(rows) * 9)
    assert len(written(spark) - folders) <= 2        # the entries and the result
    # the same iteration with dense matrices, from the same noise
    term = spark.createDataFrame([(t,) for t in names], "term string")
    noise = {r["term"]: r["q"] for r in term.select("term", F.array(*[F.hash("term", F.lit(5 + i)) / F.lit(2.0 ** 31) for i in range(6)]).alias("q")).collect()}
    Q = np.array([noise[t] for t in names])
    e, U = np.linalg.eigh(Q.T @ Q)
    Q = Q @ (U / np.sqrt(e)) @ U.T
    for _ in range(4):
        last = Q
        S, V = np.linalg.eigh(Q.T @ (X.T @ (X @ Q)))
        Q = np.linalg.qr(X.T @ (X @ Q) @ V[:, ::-1])[0]
    assert got.S == pytest.approx(S[::-1][:2] / 90, rel=1e-9)
    mine = {r["term"]: r["u"] for r in got.directions.collect()}
    assert abs(np.array([mine[t] for t in names])) == pytest.approx(abs(last @ V[:, ::-1][:, :2]), abs=1e-8)


def test_numbers_keep_their_values_when_packed():
    for a in ([], [0, 255], [256], [70_000, -1], [1.5, 2.0], [-3], [2 ** 31 - 1]):
        assert MS.unpack(MS.pack(np.array(a)), len(a)).tolist() == a
    rows = pa.table({"terms": ["a\nb\nc", "", "b"], "n": pa.array([[1, 2, 300], [], [7]], pa.list_(pa.int32()))})
    t = MS.by_term(rows, np.arange(3), 5, True, [11, 12], 3)
    found = {}
    for r in t.to_pylist():
        size = MS.unpack(r["size"], len(r["terms"].split("\n")))
        assert r["block"] in (11, 12) and r["part"] == 5 and 0 <= r["run"] < 3
        at, n = (MS.unpack(r[c], size.sum()) for c in ("at", "n"))
        term = np.repeat(r["terms"].split("\n"), size)
        found.update(zip(zip(term.tolist(), at.tolist()), n.tolist()))
    assert found == {("a", 0): 1, ("b", 0): 2, ("c", 0): 300, ("b", 2): 7}


def test_models_of_many_views_are_dealt_to_tasks_so_that_few_send_margins(spark):
    counts, labels = frames(spark)
    settings = [MS.Setting(1, h, idf, True, a) for h, idf, a in itertools.product((1, 2), (True, False), (1e-2, 1e-3))]
    many = MS.fit(MS.prepare(counts, labels, settings, folds=3, fold="f", min_df=2, entries=600), 2)
    slots = spark.sparkContext.defaultParallelism
    of = MS.groups(many)
    assert sorted(j for g in of for j in g) == list(range(len(many.models))) and len(of) == min(12, -(-slots // 2))
    moved = MS.shared(many).agg(F.sum(F.length("v"))).first()[0]
    # every block of terms sent all of them before
    assert moved <= 8 * sum(many.posted.sizes.values()) * len(many.models) * -(-slots // len(of))


def test_many_entries_make_few_blocks_and_packed_rows(spark):
    counts, labels = frames(spark)
    setting = [MS.Setting(1, 2, True, True, 1e-2)]
    slots = spark.sparkContext.defaultParallelism
    few = MS.fit(MS.prepare(counts, labels, setting, min_df=2, entries=600), 2)
    many = MS.fit(MS.prepare(counts, labels, setting, min_df=2, entries=50_000_000 * slots), 2)
    assert len(many.posted.blocks) == slots
    assert few.posted.posts.count() <= slots * len(few.posted.sizes)     # a row a part and run, not a row a term
    assert weights(many) == pytest.approx(weights(few), abs=1e-12)


def test_passes_leave_no_shuffle_files_and_one_state(spark):
    counts, labels = frames(spark)
    many = MS.prepare(counts, labels, [MS.Setting(1, 2, True, True, 1e-2)], min_df=2, entries=600)
    files, folders = shuffle_files(spark), written(spark)
    done = MS.fit(many, 4)
    assert not shuffle_files(spark) - files and len(written(spark) - folders) == 1
    assert weights(MS.fit(MS.fit(many, 1), 3, start=1)) == pytest.approx(weights(done), abs=1e-12)
