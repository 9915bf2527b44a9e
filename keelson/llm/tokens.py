"""Token counts of whole texts (see :mod:`keelson.llm.bytebpe`)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import small_batches


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``vocabulary`` is the path of a byte-level BPE .json file, readable on
    every executor.  A null text counts as an empty one (0 tokens).  Rows are
    counted each by itself, so repeated rows and null keys stay.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from keelson.llm.bytebpe import TokenCounter
        counter = TokenCounter(vocabulary)
        for b in batches:
            b["n_tokens"] = counter.count(b.pop("_text").tolist())
            yield b

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("_key"), F.octet_length(whole).cast("long").alias("n_bytes"),
                      whole.alias("_text")).mapInPandas(run, f"_key {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("_key").alias(key), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
