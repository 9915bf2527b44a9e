"""The classifiers and the component map as Spark ML stages (T12, C8, N9, D5,
E8): estimators with Params, fitted models that transform frames, and both of
them written and read, alone or inside a Pipeline, and tuned by
CrossValidator.

A model's state is a small JSON object and, where it grows with the data (term
weights), a table beside the metadata; nothing of the vocabulary's size goes
through the driver."""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.expr import col, complete_vector, sigmoid
from keelson.operators import logistic as LG
from keelson.operators import many_sparse as MS
from keelson.operators import network as NN
from keelson.operators import pca as PC
from keelson.operators import text as TX
from keelson.operators.features import distinct_classes
from keelson.operators.joins import join_skewed
from keelson.session import cut_lineage


# ---- persistence of fitted models -------------------------------------------------
class _StateWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"state": m.state, "tables": sorted(m.tables)})
        for name, table in m.tables.items():
            table.write.parquet(f"{path}/{name}")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls()
        out._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(out, meta)
        out.state = meta["state"]
        out.tables = {name: self.sparkSession.read.parquet(f"{path}/{name}") for name in meta["tables"]}
        return out


class StateModel(Model, MLWritable, MLReadable):
    """A fitted model: Params, a JSON-able ``state`` and ``tables``."""

    def __init__(self):
        super().__init__()
        self.state: dict = {}
        self.tables: dict[str, DataFrame] = {}

    def copy(self, extra=None):
        out = super().copy(extra)
        out.state, out.tables = self.state, self.tables
        return out

    def write(self):
        return _StateWriter(self)

    @classmethod
    def read(cls):
        return _StateReader(cls)


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, kind)


class HasColumns(Params):
    featuresCol = _param("featuresCol", "input column", TypeConverters.toString)
    labelCol = _param("labelCol", "label column", TypeConverters.toString)
    predictionCol = _param("predictionCol", "output column with the class", TypeConverters.toString)
    scoresCol = _param("scoresCol", "output column with one number a class", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", scoresCol="scores")

    def _fitted(self, model: StateModel, state: dict, tables: dict | None = None):
        model.state, model.tables = state, tables or {}
        return self._copyValues(model)


class _Stage(HasColumns, Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """Keyword arguments set Params."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._set(**self._input_kwargs)

    def setParams(self, **kwargs):
        return self._set(**kwargs)


def _jsonable(values) -> list:
    return [v.item() if isinstance(v, np.generic) else v for v in values]


def _with_class(df: DataFrame, scores: str, prediction: str, classes: list) -> DataFrame:
    """The class of the greatest score (first wins); null without scores."""
    at = F.array_position(scores, F.array_max(scores)).cast("int")
    named = F.element_at(F.array(*[F.lit(c) for c in classes]), at)
    return df.withColumn(prediction, F.when(F.col(scores).isNotNull(), named))


# ---- text ------------------------------------------------------------------------
class TextParams(HasColumns):
    low = _param("low", "fewest words of a term", TypeConverters.toInt)
    high = _param("high", "most words of a term", TypeConverters.toInt)
    useIdf = _param("useIdf", "weigh by inverse document frequency", TypeConverters.toBoolean)
    minDf = _param("minDf", "documents that a term needs", TypeConverters.toInt)
    alpha = _param("alpha", "weight of the penalty", TypeConverters.toFloat)
    maxIter = _param("maxIter", "passes over the documents", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="text", low=1, high=1, useIdf=True, minDf=1, alpha=1e-3, maxIter=8)


def _numbered(df: DataFrame, text: str) -> DataFrame:
    """``df`` with a row number _row, written: both sides of a later join must
    see the same numbers."""
    return cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))


class HingeText(_Stage, TextParams):
    """Counts -> tf-idf -> one-vs-rest hinge classifier of a text column."""

    def _fit(self, dataset: DataFrame) -> "HingeTextModel":
        get = self.getOrDefault
        rows = _numbered(dataset.select(F.col(get("featuresCol")).cast("string").alias("_t"), F.col(get("labelCol")).alias("_l")), "_t")
        counts = cut_lineage(TX.ngram_counts(rows, "_row", "_t", get("low"), get("high")))
        setting = MS.Setting(get("low"), get("high"), get("useIdf"), True, get("alpha"))
        many = MS.fit(MS.prepare(counts, rows, [setting], id_col="_row", label="_l", min_df=get("minDf")), get("maxIter"))
        weights = cut_lineage(many.weights().select("term", F.col("idf")[0].alias("idf"), "w"))
        return self._fitted(HingeTextModel(), {"classes": _jsonable(many.classes), "bias": [float(b) for b in many.bias]}, {"weights": weights})


class HingeTextModel(StateModel, TextParams):
    """Adds ``scores`` (a margin a class; of two classes minus and plus the
    second one's) and ``prediction``; a text without known terms has the
    intercepts."""

    def __init__(self):
        StateModel.__init__(self)
        TextParams.__init__(self)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get, classes, bias = self.getOrDefault, self.state["classes"], self.state["bias"]
        rows = _numbered(dataset, get("featuresCol"))
        slim = rows.select("_row", F.col(get("featuresCol")).cast("string").alias("_t"))
        counts = cut_lineage(TX.ngram_counts(slim, "_row", "_t", get("low"), get("high")))
        met = join_skewed(counts, self.tables["weights"], ["term"], "inner").withColumn("_x", F.col("n") * F.col("idf"))
        sums = met.groupBy("_row").agg(F.sqrt(F.sum(F.col("_x") * F.col("_x"))).alias("_norm"),
                                       *[F.sum(F.col("_x") * F.col("w")[i]).alias(f"_m{i}") for i in range(len(bias))])
        each = [F.coalesce(F.when(F.col("_norm") > 0, F.col(f"_m{i}") / F.col("_norm")), F.lit(0.0)) + F.lit(float(b)) for i, b in enumerate(bias)]
        if len(classes) == 2:
            # a margin of 0 is of the second class
            s, at = F.array(-each[0], each[0]), F.when(each[0] >= 0, 2).otherwise(1)
        else:
            s = F.array(*each)
            at = F.array_position(s, F.array_max(s)).cast("int")
        name = F.element_at(F.array(*[F.lit(c) for c in classes]), at)
        scored = rows.join(sums, "_row", "left").withColumn(get("scoresCol"), s).withColumn(get("predictionCol"), name)
        return scored.select(*[c for c in dataset.columns if c not in (get("scoresCol"), get("predictionCol"))],
                             get("scoresCol"), get("predictionCol"))


# ---- array features --------------------------------------------------------------
class LogisticParams(HasColumns):
    lam = _param("lam", "weight of the penalty", TypeConverters.toFloat)
    maxIter = _param("maxIter", "Newton passes", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(lam=1.0, maxIter=25)


class Logistic(_Stage, LogisticParams):
    """One-vs-all logistic regression on an array column."""

    def _fit(self, dataset: DataFrame) -> "LogisticStageModel":
        get = self.getOrDefault
        m = LG.fit_one_vs_all(dataset, get("featuresCol"), get("labelCol"), get("lam"), max_iter=get("maxIter"))
        return self._fitted(LogisticStageModel(), {"classes": _jsonable(m.classes), "thetas": [[float(v) for v in m.thetas[c]] for c in m.classes]})


class LogisticStageModel(StateModel, LogisticParams):
    """Adds ``scores`` (a probability a class) and ``prediction``."""

    def __init__(self):
        StateModel.__init__(self)
        LogisticParams.__init__(self)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        x = col(get("featuresCol")).cast("array<double>")
        p = [sigmoid(F.aggregate(F.zip_with(x, F.array(*[F.lit(v) for v in t[1:]]), lambda a, b: a * b), F.lit(t[0]), lambda s, v: s + v))
             for t in self.state["thetas"]]
        out = dataset.withColumn(get("scoresCol"), F.when(complete_vector(get("featuresCol")), F.array(*p)))
        return _with_class(out, get("scoresCol"), get("predictionCol"), self.state["classes"])


class NetworkParams(HasColumns):
    hiddenSizes = _param("hiddenSizes", "units of each hidden layer", TypeConverters.toListInt)
    lam = _param("lam", "weight of the penalty", TypeConverters.toFloat)
    maxIter = _param("maxIter", "iterations", TypeConverters.toInt)
    seed = _param("seed", "of the first weights", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(hiddenSizes=[5], lam=1.0, maxIter=20, seed=0)


class Network(_Stage, NetworkParams):
    """A fully connected network on an array column."""

    def _fit(self, dataset: DataFrame) -> "NetworkStageModel":
        get = self.getOrDefault
        classes = distinct_classes(dataset, get("labelCol"))
        rows = NN.training_rows(dataset, get("featuresCol"), get("labelCol"), classes).persist()
        try:
            first = rows.select(F.size("_x").alias("k")).first()
            if first is None:
                raise ValueError("no usable row to fit")
            sizes = [first["k"], *get("hiddenSizes"), len(classes)]
            W = [NN.init_random(b, a, seed=get("seed") + i) for i, (a, b) in enumerate(zip(sizes, sizes[1:]))]
            fitted = NN.train_many(rows, [NN.Spec(W, get("lam"))], len(classes), get("maxIter"))[0]
        finally:
            rows.unpersist()
        return self._fitted(NetworkStageModel(), {"classes": _jsonable(classes), "weights": [w.tolist() for w in fitted.weights]})


class NetworkStageModel(StateModel, NetworkParams):
    """Adds ``scores`` (the outputs) and ``prediction``."""

    def __init__(self):
        StateModel.__init__(self)
        NetworkParams.__init__(self)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        W = [np.array(w) for w in self.state["weights"]]
        kept = [c for c in dataset.columns if c not in (get("scoresCol"), get("predictionCol"))]
        out = NN.forward(dataset, get("featuresCol"), W, kept).withColumnRenamed("a", get("scoresCol"))
        return _with_class(out, get("scoresCol"), get("predictionCol"), self.state["classes"])


class ComponentsParams(Params):
    inputCol = _param("inputCol", "array column", TypeConverters.toString)
    outputCol = _param("outputCol", "array column with the projection", TypeConverters.toString)
    k = _param("k", "components", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="components", k=2)


class Components(ComponentsParams, Estimator, DefaultParamsWritable, DefaultParamsReadable):
    """Leading components of an array column (uncentred), as a feature map."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ComponentsModel":
        m = PC.subspace(dataset, self.getOrDefault("inputCol"), self.getOrDefault("k"))
        out = ComponentsModel()
        out.state = {"U": m.U.tolist(), "S": m.S.tolist()}
        return self._copyValues(out)


class ComponentsModel(StateModel, ComponentsParams):
    def __init__(self):
        StateModel.__init__(self)
        ComponentsParams.__init__(self)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        m = PC.PCAModel(np.array(self.state["U"]), np.array(self.state["S"]))
        return PC.project_array(dataset, self.getOrDefault("inputCol"), m, m.U.shape[1], self.getOrDefault("outputCol"))


# ---- evaluation ------------------------------------------------------------------
class Accuracy(HasColumns, Evaluator, DefaultParamsWritable, DefaultParamsReadable):
    """Share of rows with a label whose prediction is right; nan without any."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        label, pred = F.col(self.getOrDefault("labelCol")), F.col(self.getOrDefault("predictionCol"))
        share = dataset.filter(label.isNotNull()).agg(F.avg(F.coalesce((label == pred).cast("double"), F.lit(0.0)))).first()[0]
        return float("nan") if share is None else float(share)

    def isLargerBetter(self) -> bool:
        return True
