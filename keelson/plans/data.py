"""Design tables the registered queries read, defined once for Spark and
once as SQL text so both engines see the same columns.

* ``lineitem`` regression design: x1 = quantity/10, x2 = discount*10,
  x3 = tax*10, y = extendedprice/1000 (all rows).
* ``events`` anomaly design: value and the JSON field ``k``; truth =
  event_type 'error'.
* ``embeddings``: 64-d vectors with labels 0..9.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.plans.base import table


def li_design(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_quantity") / 10.0).alias("x1"),
                     (F.col("l_discount") * 10.0).alias("x2"),
                     (F.col("l_tax") * 10.0).alias("x3"),
                     (F.col("l_extendedprice") / 1000.0).alias("y"),
                     (F.col("l_returnflag") == "R").cast("double").alias("yr"),
                     F.col("l_returnflag").alias("flag"))


LI_SQL = ("SELECT l_orderkey, l_linenumber, l_quantity / 10.0 AS x1, l_discount * 10.0 AS x2, "
          "l_tax * 10.0 AS x3, l_extendedprice / 1000.0 AS y, "
          "CAST(l_returnflag = 'R' AS DOUBLE) AS yr, l_returnflag AS flag FROM lineitem")


def ev_design(spark: SparkSession, sf: str) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.select("event_id", "user_id", "event_type", "value", "ts",
                     F.get_json_object("props", "$.k").try_cast("double").alias("k"),
                     (F.col("event_type") == "error").cast("int").alias("is_error"))


EV_SQL = ("SELECT event_id, user_id, event_type, value, ts, "
          "CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, "
          "CAST(event_type = 'error' AS INTEGER) AS is_error FROM events")


def emb(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")


EMB_DIMS = 64
