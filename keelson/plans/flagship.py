"""The flagship query: lineitem design -> normaliser (Z1/Z2) -> Gram scan
(L4) -> normal equation (L5) -> training cost (L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.operators import features as FT
from keelson.operators import gram as G
from keelson.plans.data import li_design


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    d = li_design(spark, sf)
    feats = ["x1", "x2", "x3"]
    nm = FT.fit_normalizer(d, feats)
    Gm = G.gram(FT.normalize(d, nm), feats, "y")
    theta = G.solve(Gm)
    J = G.cost(Gm, theta)
    names = ["intercept"] + feats
    rows = [(n, float(t), float(J)) for n, t in zip(names, theta)]
    return spark.createDataFrame(rows, "term string, theta double, train_cost double") \
        .withColumn("m", F.lit(int(Gm[0, 0])))
