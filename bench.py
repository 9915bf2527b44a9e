"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and executed in full (``write.format("noop")``, so
no result is collected); the time includes any fitting jobs the query
runs.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "gram", "lin_normal", "lin_predict", "normalize", "equalize_hist", "log_gd_steps",
    "log_fit", "ova_fit", "confusion", "best_threshold", "kmeans_fit", "pca_cov", "tfidf",
    "word_indices", "nb_predict", "cofi_gradient", "recommend_topk", "nn_gradient",
    "kfold_oof", "learning_curve", "fold_mean", "text_svm", "svm_grid", "cofi_train",
    "nn_train", "text_classify", "porter_stems", "kfold_logistic", "text_svm_multi", "cofi_blocked",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from keelson.plans import registry
    from keelson.session import get_session

    if os.environ.get("BENCH_EVENT_LOG"):
        # stage and task times for offline reading, in a fresh scratch folder
        import tempfile
        from pyspark.sql import SparkSession
        SparkSession.builder.config("spark.eventLog.enabled", "true").config(
            "spark.eventLog.dir", tempfile.mkdtemp(prefix="bench-events-", dir="/tmp"))
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 16g pyspark-shell")
    spark = get_session(master=f"local[{cpus}]", partitions=cpus)
    reg = registry()
    keys = os.environ.get("BENCH_QUERIES")
    keys = keys.split(",") if keys else HEADLINE
    # warm-up (not a headline query): JVM JIT, codegen, file listing and
    # the Python worker used by Arrow tasks
    from pyspark.sql import functions as F
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.groupBy("o_orderstatus").agg(F.sum("o_totalprice"), F.avg("o_totalprice")) \
        .write.format("noop").mode("overwrite").save()
    orders.select("o_totalprice").mapInPandas(lambda it: it, "o_totalprice double") \
        .write.format("noop").mode("overwrite").save()
    times = {}
    for k in keys:
        t0 = time.perf_counter()
        reg[k].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))


if __name__ == "__main__":
    main()
