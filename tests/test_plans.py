"""Physical-plan properties the operators rely on at scale."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from keelson.operators import indexing as IX


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_per_group_limits_before_the_shuffle(spark):
    df = spark.range(0, 10000).select((F.col("id") % 3).alias("g"), "id")
    plan = _plan(IX.top_k_per_group(df, ["g"], [F.col("id")], 5))
    # a partial group limit runs below the exchange, a final one above it
    assert plan.count("WindowGroupLimit") >= 2
    lower = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in lower


def test_global_row_index_has_no_single_partition_window(spark):
    df = spark.range(0, 1000, numPartitions=4).select((F.col("id") * 37 % 1000).alias("k"))
    out = IX.global_row_index(df, ["k"])
    assert "Window" not in _plan(out)
    assert "SinglePartition" not in _plan(out)


def test_hot_user_is_salted(spark):
    """With broadcasting off, the gradient by user combines per task before a
    shuffle of its own instead of reusing the join's partitioning."""
    from keelson.operators import recommend as RC
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = spark.createDataFrame([(1, i, 1.0) for i in range(20)] + [(2, 1, 2.0)], "user long, item long, rating double")
        X = r.select("item").distinct().withColumn("x0", F.lit(0.5))
        T = r.select("user").distinct().withColumn("t0", F.lit(0.5))
        j = RC.salted_join(r, T, "user", "item").groupBy("user").agg(F.sum("t0").alias("s"))
        plan = _plan(j)
        assert "user#" in plan and "_salt" in plan
        top = plan[:plan.index("SortMergeJoin")]
        assert "partial_sum" in top or plan.count("Exchange") >= 3
        assert {x.user: x.s for x in j.collect()} == {1: 10.0, 2: 0.5}
        g = {(x.kind, x.id): x.grad for x in RC.gradient(r, X, T, 1, 0.0).collect()}
        assert abs(g[("Theta", 1)] - 20 * (0.25 - 1.0) * 0.5) < 1e-12
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.skipif(not os.path.isdir(SF0001), reason="test tables absent")
def test_scan_prunes_and_pushes(spark):
    from keelson.plans import registry
    df = registry()["scan_features"].fn(spark, SF0001).filter("l_quantity > 10")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "l_comment" not in plan and "l_shipdate" not in plan


@pytest.mark.skipif(not os.path.isdir(SF0001), reason="test tables absent")
def test_gram_is_one_partial_aggregate(spark):
    from keelson.operators import gram as G
    from keelson.plans.data import li_design
    plan = _plan(G.gram_frame(li_design(spark, SF0001), ["x1", "x2", "x3"], "y"))
    assert plan.count("HashAggregate") == 2  # partial + final, one tiny exchange
    assert "l_returnflag" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_trained_factors_and_means_are_not_repeated_for_salts(spark, monkeypatch):
    from keelson.operators import recommend as RC
    from keelson.plans import q_recsvm as Q
    monkeypatch.setattr(RC, "salted_join", None)
    top = Q.recommend_trained(spark, SF0001).collect()
    assert sorted(r["rank"] for r in top) == list(range(1, 11))
    joined, blocked = ([r["J"] for r in f(spark, SF0001).orderBy("iter").collect()] for f in (Q.cofi_train, Q.cofi_blocked))
    assert len(joined) == 3 and joined == sorted(joined, reverse=True)
    assert joined == pytest.approx(blocked, rel=1e-9)
