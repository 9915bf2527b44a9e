"""Stages fit, transform, are written and read back, and run in pipelines and
cross-validation."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from keelson.operators import logistic as LG
from keelson.operators import many_sparse as MS
from keelson.operators import stages as ST
from tests.test_many_models import blobs
from tests.test_many_sparse import corpus, frames


def table(df, *cols):
    return sorted(tuple(str(v) if not isinstance(v, list) else tuple(round(x, 9) for x in v) for v in r) for r in df.select(*cols).collect())


def test_hinge_text_stage(spark, scratch):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, label string, f int")
    model = ST.HingeText(high=2, minDf=2, maxIter=4, alpha=1e-2).fit(df)
    out = model.transform(df.withColumn("scores", F.lit("own")))
    assert out.count() == len(rows) and out.columns == ["doc_id", "text", "label", "f", "scores", "prediction"]
    counts, labels = frames(spark, rows)
    many = MS.fit(MS.prepare(counts, labels, [MS.Setting(1, 2, True, True, 1e-2)], min_df=2), 4)
    want = {r["doc_id"]: r for r in MS.predictions(many).collect()}
    got = {r["doc_id"]: r for r in out.collect()}
    for i, r in want.items():
        assert got[i]["prediction"] == r["pred"] and max(got[i]["scores"]) == pytest.approx(r["score"], abs=1e-9)
    assert got[902]["prediction"] in ("x", "y", "z")        # no label, scored all the same
    model.write().overwrite().save(f"{scratch}/hinge")
    again = ST.HingeTextModel.load(f"{scratch}/hinge")
    assert table(again.transform(df), "doc_id", "scores", "prediction") == table(out, "doc_id", "scores", "prediction")
    assert again.getOrDefault("high") == 2


def test_a_saved_pipeline_predicts_alike(spark, scratch):
    _, y, _, df = blobs(spark, 150, 3, 6)
    df = df.unionByName(spark.createDataFrame([(900, None, None, 0), (901, [float("nan")] * 6, None, 0)], "id long, x array<double>, y int, f int"))
    pipe = Pipeline(stages=[ST.Components(inputCol="x", outputCol="c", k=4), ST.Logistic(featuresCol="c", labelCol="y", lam=0.5),
                            ST.Network(featuresCol="c", labelCol="y", hiddenSizes=[3], maxIter=5, predictionCol="net", scoresCol="outputs")])
    pipe.write().overwrite().save(f"{scratch}/pipe")
    fitted = Pipeline.load(f"{scratch}/pipe").fit(df)
    fitted.write().overwrite().save(f"{scratch}/model")
    again = PipelineModel.load(f"{scratch}/model")
    cols = ["id", "c", "scores", "prediction", "outputs", "net"]
    a, b = fitted.transform(df), again.transform(df)
    assert table(a, *cols) == table(b, *cols)
    rows = {r["id"]: r for r in a.collect()}
    assert rows[900]["prediction"] is rows[901]["prediction"] is rows[900]["net"] is None and len(rows) == 152
    ova = LG.fit_one_vs_all(a.filter("y IS NOT NULL"), "c", "y", lam=0.5)
    for i in range(0, 150, 29):
        p = [1 / (1 + np.exp(-(ova.thetas[c][0] + ova.thetas[c][1:] @ np.array(rows[i]["c"])))) for c in ova.classes]
        assert rows[i]["scores"] == pytest.approx(p, abs=1e-8) and rows[i]["prediction"] == int(np.argmax(p))
    hits = ST.Accuracy(labelCol="y").evaluate(a)
    assert hits == pytest.approx(np.mean([rows[i]["prediction"] == y[i] for i in range(150)])) and hits > 0.7
    assert np.isnan(ST.Accuracy(labelCol="y").evaluate(a.limit(0)))


def test_cross_validation_picks_the_better_setting(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((120, 2))
    y = (x[:, 0] > 0).astype(int)
    df = spark.createDataFrame([([float(v) for v in r], int(t)) for r, t in zip(x, y)], "features array<double>, label int").repartition(2)
    est = ST.Logistic(maxIter=6)
    grid = ParamGridBuilder().addGrid(est.lam, [1e6, 0.1]).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=ST.Accuracy(), numFolds=2, seed=1).fit(df)
    assert cv.avgMetrics[1] > 0.9 and cv.bestModel.getOrDefault("lam") == 0.1
    assert cv.transform(df).filter("prediction = label").count() > 110
