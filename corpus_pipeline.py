"""The training-data pipeline over ``documents``.

STAGES in order: the quality classifier drops junk and toxic documents, the
n-gram Jaccard join keeps one document of each near-duplicate group, benchmark
decontamination drops documents that overlap the benchmark, Poisson mixing
repeats documents so that sources meet their weights, and packing writes token
ids into fixed-length sequences.  Each stage takes (spark, docs, sf_dir) and
all but the last return the columns of ``docs``.  ``run`` writes every stage as
Parquet under spark.checkpoint.dir and reads it again as the next one's input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from keelson.llm import decontam, mixing, quality, queries, setjoin
from keelson.session import checkpoint_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier, fitted on this input and the
    given labels, rejects."""
    model = quality.fit(docs, queries.table(spark, sf_dir, "labels"))
    return quality.classify(docs, model, prefix="_q_").filter("_q_keep").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of documents linked
    by a Jaccard similarity of five-word shingles of at least 0.8."""
    return setjoin.keep_one(docs, similarity=0.8, k=5).select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap a benchmark item."""
    return decontam.decontaminate(docs, queries.table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents by a Poisson count, so that a source's share follows
    its characters to the power 0.5, in shuffled order."""
    return mixing.poisson_mix(docs, temperature=0.5, epochs=1.0, seed=17, copy_col="_mix_copy",
                              order_col="_mix_order").select(*docs.columns)


def pack_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack token ids into sequences of 2048."""
    return queries.packed(docs)


STAGES = [("quality", keep_good), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark),
          ("mixing", mix_sources), ("packing", pack_ids)]

# The classifier and the chosen-path join can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed sequences."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4()}"
    docs = queries.table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
