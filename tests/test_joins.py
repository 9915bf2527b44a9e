"""Joins of heavy keys: same rows, evenly dealt."""

import pytest
from pyspark.sql import functions as F

from keelson.operators.joins import heavy_keys, join_skewed


@pytest.fixture
def plain_joins(spark):
    """No broadcast by the planner, no adaptive changes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def tables(spark):
    # one term in half of the rows, another in a quarter
    key = F.when(F.col("id") % 2 == 0, "the").when(F.col("id") % 4 == 1, "of").otherwise(F.concat(F.lit("w"), (F.col("id") % 700).cast("string")))
    left = spark.range(20_000, numPartitions=6).select("id", key.alias("k"))
    right = left.select("k").distinct().withColumn("v", F.length("k")).filter("k <> 'w3'")
    return left, right


def test_no_task_reads_more_than_twice_the_median(spark, plain_joins):
    left, right = tables(spark)
    out = join_skewed(left, right, ["k"], "inner")
    per = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    assert len(per) == 8 and per[-1] <= 2 * per[len(per) // 2]
    plain = sorted(r["count"] for r in left.join(right, "k").groupBy(F.spark_partition_id()).count().collect())
    assert plain[-1] > 2 * plain[len(plain) // 2]      # what the join alone would do
    assert sorted(map(tuple, out.collect())) == sorted((r["id"], r["k"], r["v"]) for r in left.join(right, "k").collect())


def test_left_join_keeps_rows_without_a_value_and_null_keys(spark):
    left, right = tables(spark)
    left = left.withColumn("k", F.when(F.col("id") % 10 != 0, F.col("k")))
    right = right.unionByName(spark.createDataFrame([(None, -1)], "k string, v int"))
    out = {r["id"]: r["v"] for r in join_skewed(left, right, ["k"]).collect()}
    by = {r["k"]: r["v"] for r in right.collect()}
    assert out == {r["id"]: by.get(r["k"]) for r in left.collect()}
    assert join_skewed(left.limit(0), right, ["k"]).count() == 0
    assert join_skewed(left, right.limit(0), ["k"], "inner").count() == 0


def test_heavy_keys_are_few_and_counted_by_weight(spark):
    left, _ = tables(spark)
    assert {r["k"] for r in heavy_keys(left, ["k"], part=100).collect()} == {"the", "of"}
    some = spark.createDataFrame([("a", 995), ("b", 4), ("c", 1)], "k string, n long")
    assert {r["k"] for r in heavy_keys(some, ["k"], "n", part=10).collect()} == {"a"}
