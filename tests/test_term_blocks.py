"""Entries stay in blocks of terms: only documents' steps and margins move."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import many_sparse as MS
from keelson.operators import pca as PC
from keelson.operators import sparse_linear as SL
from keelson.operators import text as TX
from tests.test_many_sparse import corpus


def frames(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, f int")
    return docs, docs.select("doc_id", "label", "f")


def test_lists_give_what_rows_give_and_no_pass_shuffles_entries_or_weights(spark, monkeypatch):
    docs, labels = frames(spark, [r for r in corpus(30) if r[3] is not None])
    setting = [MS.Setting(1, 2, True, True, 1e-2)]
    few = MS.fit(MS.prepare(TX.count_lists(docs, "doc_id", "text", 1, 2), labels, setting, min_df=2, entries=600), 2)
    key = lambda m: {(r["term"], r["class"]): r["weight"] for r in m.table().collect()}
    monkeypatch.setattr(MS, "SLICE", 7)         # many runs of terms
    rows = MS.fit(MS.prepare(TX.ngram_counts(docs, "doc_id", "text", 1, 2), labels, setting, min_df=2), 2)
    assert key(rows) == pytest.approx(key(few), abs=1e-12)
    # what a pass moves: a byte or two a document, model and block out, eight back
    n = sum(few.posted.sizes.values())
    shares = MS.passed(few, MS.margins, "part int, v binary")
    assert shares.agg(F.sum(F.length("v"))).first()[0] == 8 * n * len(few.models) * len({r["block"] for r in few.posted.posts.select("block").distinct().collect()})
    plan = few.posted.posts.groupBy("block").cogroup(few.posted.docs.groupBy("part")).applyInArrow(lambda a, b: a, few.posted.posts.schema)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort " not in text


def test_hinge_from_lists_counts_only_documents_with_entries(spark):
    rows = [(i, t, "p" if l == "x" else "a", f) for i, t, l, f in corpus(30) if l is not None]
    docs, labels = frames(spark, rows)
    zero_one = labels.select("doc_id", (F.col("label") == "p").cast("int").alias("label"))
    lists = TX.count_lists(docs, "doc_id", "text").withColumn("w", F.col("n").cast("array<double>"))
    long = TX.term_counts(docs, "doc_id", "text").withColumn("w", F.col("n").cast("double"))
    a, b = (SL.fit_hinge(x, zero_one, alpha=1e-2, iters=3, t0=7.0) for x in (lists, long))
    assert {r["term"]: r["weight"] for r in a[0].collect()} == pytest.approx({r["term"]: r["weight"] for r in b[0].collect()}, abs=1e-12)
    assert a[1] == pytest.approx(b[1]) and [J for _, J in a[2]] == pytest.approx([J for _, J in b[2]]) and a[2][0] == (0, 1.0)


def test_subspace_of_lists_equals_that_of_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"t{j}", float(v)) for i in range(40) for j, v in enumerate(rng.random(12)) if v < 0.5]
    df = spark.createDataFrame(rows, "doc_id long, term string, w double")
    lists = TX.listed(df, "doc_id", "term", "w").withColumnRenamed("n", "w")
    one, two = PC.sparse_subspace(df, 2, iters=5), PC.sparse_subspace(lists, 2, iters=5, entries=len(rows))
    assert one.S == pytest.approx(two.S, rel=1e-9)
