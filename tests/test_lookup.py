"""Counts within rows and look-ups by routing: right rows, little shuffled."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from keelson.operators import text as TX

DOCS = [(1, "b a b a b"), (2, ""), (3, None), (4, "one1 a_b zz"), (4, "zz zz yy"), (None, "xx yy"), (None, "xx"), (5, "zz"), (6, "Été été ÉTÉ x")]


def docs(spark, rows=DOCS):
    return spark.createDataFrame([(i, t and t.replace("a ", "aa ").replace("b ", "bb ")) for i, t in rows], "doc_id long, text string").repartition(3)


def brute(rows, low, high):
    import re
    out = Counter()
    for i, t in rows:
        w = re.findall(r"\w{2,}", (t or "").lower())
        out.update((i, " ".join(w[k:k + n])) for n in range(low, high + 1) for k in range(len(w) - n + 1))
    return out


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_ngram_counts_shuffle_only_rows_that_share_an_id(spark):
    d = docs(spark)
    rows = [tuple(r) for r in d.collect()]
    for low, high in ((1, 1), (1, 2), (2, 3)):
        got = {(r["doc_id"], r["term"]): r["n"] for r in TX.ngram_counts(d, "doc_id", "text", low, high).collect()}
        assert got == brute(rows, low, high)
    scan = d.filter(F.col("doc_id").isNotNull() & (F.col("doc_id") != 4)).coalesce(1)
    slots = scan.sparkSession.sparkContext.defaultParallelism
    wide = scan.repartition(slots)
    assert exchanges(TX.ngram_counts(wide, "doc_id", "text")) == exchanges(wide)


def test_bigram_counts_shuffle_nothing_of_rows_with_their_own_ids(spark):
    d = docs(spark)
    got = {(r["doc_id"], r["bigram"]): r["n"] for r in TX.bigram_counts(d, "doc_id", "text").collect()}
    assert got == brute([tuple(r) for r in d.collect()], 2, 2)
    wide = d.filter("doc_id in (1, 5, 6)").repartition(d.sparkSession.sparkContext.defaultParallelism)
    assert exchanges(TX.bigram_counts(wide, "doc_id", "text")) == exchanges(wide)


def stems(spark, rows, full):
    from keelson.functions.porter import stem
    cut = lambda t: next((t[:-len(a)] + b for a, b in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")) if t.endswith(a)), t)
    return [(i, p, (stem if full else cut)(w)) for i, t in rows for p, w in enumerate((t or "").split())]


@pytest.mark.parametrize("full", [False, True])
def test_word_indices_ship_a_frequent_term_once_a_block(spark, full):
    from keelson.operators import lookup as LU
    rows = [(i, "ponies cats the the running " + f"only{i}x") for i in range(40)] + [(7, "again twice"), (7, "twice"), (None, "nulls"), (None, "nulls the"), (41, ""), (42, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    dealt = LU.deal(TX.stem_lists(d, "doc_id", "text", full), 10, distinct=False)
    clean = [(i, t and t.replace("0", "number") and "".join("#" if c.isdigit() else c for c in t)) for i, t in rows]
    import re
    clean = [(i, t and re.sub("#+", "number", t)) for i, t in clean]
    want = stems(spark, clean, full)
    df = Counter(s for _, s in {(i, s) for i, _, s in want})
    n = Counter(s for _, _, s in want)
    held = {r["term"]: r for r in dealt.held.collect()}
    assert {t: r["df"] for t, r in held.items()} == df and {t: r["n"] for t, r in held.items()} == n
    assert all(len(r["blocks"]) <= dealt.rows.rdd.getNumPartitions() for r in held.values())
    at = {s: k for k, s in enumerate(sorted(s for s in df if df[s] >= 2), 1)}
    vocab = TX.vocabulary(dealt, 2, 1)
    got = Counter(tuple(r) for r in TX.word_indices(dealt, vocab).select("doc_id", "pos", "idx").collect())
    assert got == Counter((i, p, at[s]) for i, p, s in want if s in at)
    plan = TX.word_indices(dealt, vocab)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1     # the values go to the blocks, the tokens stay


def test_presence_by_row_and_by_shared_id(spark):
    d = spark.createDataFrame([(1, [3, None, 3, 1]), (2, [4, 4]), (2, [4, 5]), (None, [1]), (3, []), (4, [None])], "doc_id long, idx array<long>")
    got = {tuple(r) for r in TX.term_presence(d).collect()}
    assert got == {(1, 3, 2), (1, 1, 2), (2, 4, 2), (2, 5, 2)}


def test_tfidf_evaluates_a_norm_once_a_document_and_moves_no_entry_by_term(spark):
    import math
    from keelson.operators import lookup as LU
    rows = [(1, "aa bb aa cc"), (2, "aa dd"), (3, ""), (4, "bb"), (4, "bb ee"), (None, "aa ff")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    dealt = LU.deal(TX.count_lists(d, "doc_id", "text"), 10)
    lists = TX.tfidf_lists(dealt, TX.idf_values(dealt, 6))
    got = {(r["doc_id"], r["term"]): r["w"] for r in TX.tfidf_rows(lists).collect()}
    counts = brute(rows, 1, 1)
    df = Counter(t for _, t in counts)
    w = {k: n * (math.log(7 / (1 + df[k[1]])) + 1) for k, n in counts.items()}
    norm = {i: math.sqrt(sum(v * v for (j, _), v in w.items() if j == i)) for i, _ in w}
    want = {(i, t): v / norm[i] for (i, t), v in w.items() if i is not None}
    assert got == pytest.approx(want)
    long = {(r["doc_id"], r["term"]): r["w"] for r in TX.tfidf(TX.term_counts(d, "doc_id", "text"), 6).collect()}
    assert long == pytest.approx(want)
    plan = TX.tfidf_rows(lists)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    lines = [p for p in plan.splitlines() if "aggregate(" in p and "transform(" in p]
    assert not lines        # the norm isn't merged into the lambda
