"""The repeated query blocks are joined by shuffle, never sent through the driver."""

import numpy as np

from keelson.llm import knn


def test_no_query_block_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(knn, "CANDIDATE_ROWS", 16)
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=8)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    found = knn.nearest(df.filter("vec_id % 10 = 0"), df, 3)
    assert len(found.collect()) == 90
    plan = found._jdf.queryExecution().executedPlan().toString()     # the adaptive plan as it ran, and before
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
