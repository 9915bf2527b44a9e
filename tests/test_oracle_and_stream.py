"""Registered queries against their DuckDB oracle on sf0.001, the entry
point, and the streaming scorers on a file stream."""

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF0001

FAST_KEYS = ["normalize", "gram", "lin_normal", "ridge", "gd_history", "polymap", "equalize_hist",
             "log_cost", "ova_predict", "class_report", "best_threshold", "kmeans_fit", "pca_2d",
             "tokens", "tfidf", "nb_predict", "cofi_gradient", "nn_gradient", "kfold_oof",
             "learning_curve", "fold_mean", "limit_per_group", "log_loss", "kfold_rows", "ngram_counts",
             "text_classify", "vocab", "word_indices", "recommend_topk", "kmeans_members"]


@pytest.mark.skipif(not os.path.isdir(SF0001), reason="test tables absent")
def test_queries_match_oracle(spark):
    from keelson.plans.check import check
    res = check(SF0001, FAST_KEYS, spark=spark, verbose=False)
    bad = {k: v for k, v in res.items() if not v["ok"]}
    assert not bad, bad


def test_every_key_has_a_callable_and_sql_or_documented_fit():
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert len(q) >= 100 and set(s) <= set(q)
    from keelson.plans import registry
    own = registry()
    assert set(own) <= set(q) and all(callable(f) for f in q.values())
    # iterative or randomised fits and full stems have no SQL; each has a test of its own
    assert {k for k in own if own[k].sql is None} == {
        "cofi_train", "grid_search", "log_fit", "log_fit_wide", "nn_train", "ova_fit", "ova_fit_wide",
        "porter_stems", "porter_word_indices", "recommend_trained", "svm_fit", "svm_grid", "svm_rbf_fit", "text_svm"}


@pytest.mark.skipif(not os.path.isdir(SF0001), reason="test tables absent")
def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and df.columns == ["term", "theta", "train_cost", "m"]


@pytest.mark.skipif(not os.path.isdir(SF0001), reason="test tables absent")
def test_stream_scoring_and_windowed_anomalies(spark, scratch):
    from keelson.operators import anomaly as AN
    from keelson.plans.data import ev_design
    from keelson.streaming import scoring as ST
    ev = ev_design(spark, SF0001)
    mu, var = AN.estimate_params(ev, ["value", "k"])
    src = f"{scratch}/events_in"
    spark.read.parquet(f"{SF0001}/events.parquet").coalesce(1).write.parquet(src)  # one batch: nothing is late
    schema = spark.read.parquet(src).schema
    stream = ST.parquet_stream(spark, src, schema).select(
        "event_id", "ts", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    flagged = ST.flag_anomalies(stream, ["value", "k"], mu, var, 5e-5)
    q = ST.start(ST.outlier_counts(flagged, "ts"), "anoms", f"{scratch}/ckpt", mode="append")
    q.processAllAvailable()
    q.stop()
    got = {x["window_start"]: (x["rows"], x["anomalies"]) for x in spark.sql("SELECT * FROM anoms").collect()}
    p = F.exp(AN.log_density(["value", "k"], mu, var))
    batch = ST.outlier_counts(ev.withColumn("anomaly", p < 5e-5), "ts").collect()
    last = ev.agg(F.max("ts")).first()[0]
    closed = {x["window_start"]: (x["rows"], x["anomalies"]) for x in batch
              if x["window_start"] + timedelta(hours=3) <= last}   # window of 1 h, watermark of 2 h
    assert closed and got == closed
