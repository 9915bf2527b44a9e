"""Mixing sources to target weights by Poisson replication.

Every source s has a target share of the corpus' characters; its mean
repetition rate is ``epochs * share_s * total / chars_s``.  A document is
repeated ``Poisson(rate)`` times: a uniform number from a seeded hash of its
id is sent through the inverse Poisson distribution, so the count is the same
on every run and in every task.  Copies are dealt to partitions and sorted by
a hash of (id, copy), which shuffles the corpus globally.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from keelson.session import cut_lineage

# Sources up to which their rates are broadcast (checked by count); beyond,
# they are joined on (source, salt).  Both give the same rows.
BROADCAST_SOURCES = 20_000
SALTS = 64


def poisson_cdf(rate: float) -> np.ndarray:
    """P(X <= k) for k = 0 .. rate + 12 sqrt(rate) + 30."""
    if not rate > 0:
        return np.ones(1)
    k = np.arange(math.ceil(rate + 12 * math.sqrt(rate) + 30) + 1)
    log_fact = np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
    return np.cumsum(np.exp(k * math.log(rate) - rate - log_fact))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 52 bits of md5('seed:key')."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(2.0 ** 52)


def source_rates(docs: DataFrame, weights: dict | None = None, temperature: float = 0.5,
                 epochs: float = 1.0, source: str = "source", text: str = "text") -> DataFrame:
    """(source, chars, rate) for every source, the null source included.

    ``weights`` maps sources to target weights (others get 0); without it a
    source's weight is its characters to the power ``temperature``.  A source
    without any characters gets rate 0.
    """
    per = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.length(text), F.lit(0)).cast("long")).alias("chars"))
    if weights is None:
        w = F.pow(F.col("chars").cast("double"), F.lit(float(temperature)))
    else:
        w = F.lit(0.0)
        for name, value in weights.items():
            w = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(w)
    per = cut_lineage(per.withColumn("w", w))
    total = per.agg(F.sum("chars").alias("c"), F.sum(F.when(F.col("chars") > 0, F.col("w"))).alias("w")).first()
    all_chars, all_w = float(total["c"] or 0), float(total["w"] or 0)
    rate = F.when((F.col("chars") > 0) & F.lit(all_w > 0),
                  F.col("w") * F.lit(epochs * all_chars) / F.lit(all_w or 1.0) / F.col("chars")).otherwise(0.0)
    return per.select("source", "chars", rate.alias("rate"))


def poisson_mix(docs: DataFrame, weights: dict | None = None, temperature: float = 0.5,
                epochs: float = 1.0, seed: int = 17, key: str = "doc_id",
                source: str = "source", text: str = "text",
                copy_col: str = "copy", order_col: str = "shuffle_key") -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, shuffled.

    Keeps all columns of ``docs`` and adds ``copy`` (from 0) and
    ``shuffle_key``; existing columns of these names are replaced.  Null text
    counts 0 characters, a null source is a source of its own, a null id is
    hashed as the word null, rows with equal ids are repeated equally often.
    An empty table gives an empty table.
    """
    cdf = F.pandas_udf(lambda r: pd.Series([poisson_cdf(x) for x in r]), ArrayType(DoubleType()))
    rates = cut_lineage(source_rates(docs, weights, temperature, epochs, source, text).select(
        F.col("source").alias("_mix_source"), cdf("rate").alias("_mix_cdf")))
    left = docs.drop(copy_col, order_col)
    on = F.col(source).eqNullSafe(F.col("_mix_source"))
    if rates.count() <= BROADCAST_SOURCES:
        joined = left.join(F.broadcast(rates), on)
    else:
        salt = F.pmod(F.xxhash64(key), F.lit(SALTS))
        rates = rates.withColumn("_mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = left.join(rates, on & (salt == F.col("_mix_salt"))).drop("_mix_salt")
    u = uniform(F.col(key), seed)
    n = F.size(F.filter("_mix_cdf", lambda c: c <= F.col("_mix_u")))
    out = (joined.withColumn("_mix_u", u).withColumn("_mix_n", n)
           .filter("_mix_n > 0")
           .withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.col("_mix_n") - 1)))
           .withColumn(order_col, F.md5(F.concat(
               F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")),
               F.lit(":"), F.col(copy_col).cast("string"))))
           .drop("_mix_source", "_mix_cdf", "_mix_u", "_mix_n"))
    return out.repartition(order_col).sortWithinPartitions(order_col, copy_col)
