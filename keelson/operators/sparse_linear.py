"""Linear classifier on sparse features, trained by full-batch subgradient
descent on the L2-regularised hinge loss (T11, V1 for text).

The trainer is that of :mod:`keelson.operators.many_sparse` with one model:
entries are dealt to blocks of terms once, and an iteration moves the documents'
steps and margins.  Nothing is collected: the vocabulary size is not bounded by
driver memory."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators import many_sparse as MS
from keelson.session import cut_lineage


def fit_hinge(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", term: str = "term",
              x: str = "w", label: str = "label", alpha: float = 1e-3, iters: int = 10,
              t0: float | None = None, entries: int | None = None):
    """Minimise alpha/2 ||w||^2 + mean_i max(0, 1 - y_i (w.x_i + b)),
    y in {-1, +1} (labels 0/1 are mapped).  Documents are those with features
    and a label; a null label is none, of several labels of an id the greatest
    counts.  Step 1 / (alpha (t + t0)) with
    t0 = 1 / alpha by default (first steps close to 1, then decaying).
    ``feats``: (id, term, x) rows, or (id, terms, x) lists with about ``entries``
    entries.  Returns (weights (term, weight), bias, history [(iter, objective)])."""
    y = (labels.filter(F.col(label).isNotNull()).groupBy(id_col)
         .agg(F.max(F.when(F.col(label) > 0, 1).otherwise(0)).alias("label")))
    feats = feats.select(id_col, *(["terms"] if "terms" in feats.columns else [F.col(term).alias("term")]), F.col(x).alias("n"))
    many = MS.prepare(feats, y, [MS.Setting(1, 1 << 30, False, False, alpha)], classes=[0, 1], id_col=id_col, entries=entries, with_entries=True)
    many = dataclasses.replace(many, t0=t0)
    hist = []
    for t in range(iters):
        many = MS.fit(many, 1, start=t)
        hist.append((t, float(many.losses()[0]) + alpha / 2.0 * float(many.norm2[0])))
    weights = cut_lineage(many.weights().select(F.col("term").alias(term), F.col("w")[0].alias("weight")))
    return weights, float(many.bias[0]), hist


def decision(feats: DataFrame, weights: DataFrame, bias: float, docs: DataFrame,
             id_col: str = "doc_id", term: str = "term", x: str = "w") -> DataFrame:
    """Scores w.x + b for every document (documents without known terms
    score b); class = score >= 0."""
    s = (feats.join(weights, term).groupBy(id_col)
         .agg(F.sum(F.col(x) * F.col("weight")).alias("_s")))
    out = docs.select(id_col).join(s, id_col, "left").na.fill(0.0, ["_s"])
    score = F.col("_s") + F.lit(bias)
    return out.select(id_col, score.alias("score"), (score >= 0).cast("int").alias("pred"))
