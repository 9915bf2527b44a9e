"""Joins with a table of unique keys when a few keys hold most of the rows.

A key with more than one in ``HEAVY_PART`` of all rows is heavy; fewer than
``HEAVY_PART`` keys can be.  Their few values are broadcast (a bound that holds
for any input), the other keys are joined by shuffle, where none has more than
that part of the rows."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.session import cut_lineage

HEAVY_PART = 1000


def heavy_keys(counted: DataFrame, on: Sequence[str], weight: str | None = None,
               part: int = HEAVY_PART) -> DataFrame:
    """The keys of more than one in ``part`` rows (``weight``: a column with the
    rows that each row stands for), written; fewer than ``part`` rows."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    total = counted.agg(n).first()[0] or 0
    return cut_lineage(counted.groupBy(*on).agg(n.alias("_rows"))
                       .filter(F.col("_rows") * part > total).select(*on))


def join_skewed(rows: DataFrame, values: DataFrame, on: Sequence[str], how: str = "left",
                counted: DataFrame | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """``rows`` left (or inner) joined with ``values``, whose keys ``on`` are
    unique; null keys are equal.  Heavy keys are counted in ``counted`` (else
    ``rows``: cheap to read, or written) unless ``heavy`` names them."""
    heavy = heavy_keys(rows if counted is None else counted, on) if heavy is None else heavy
    more = [c for c in values.columns if c not in on]

    def named(df: DataFrame, p: str) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").alias(p + c) for c in df.columns])

    def equal(a: str, b: str) -> Column:
        return functools.reduce(lambda x, y: x & y, [F.col(f"`{a}{c}`").eqNullSafe(F.col(f"`{b}{c}`")) for c in on])

    hot = named(values, "_h_").join(F.broadcast(named(heavy.select(*on), "_k_")), equal("_h_", "_k_"), "left_semi")
    met = named(rows, "_r_").join(F.broadcast(hot.withColumn("_hot", F.lit(True))), equal("_r_", "_h_"), "left")
    # a heavy key's rows look for nothing more: a number of their own spreads them
    met = met.withColumn("_spread", F.when(F.col("_hot"), F.xxhash64(F.monotonically_increasing_id()).bitwiseOR(F.lit(1)))
                         .otherwise(F.lit(0)))
    # always 0, but no constant that the optimiser would take out of the join keys
    none = F.pmod(F.xxhash64(*[F.col(f"`_l_{c}`") for c in on]), F.lit(1)).cast("long")
    light = named(values, "_l_").withColumn("_none", none)
    both = met.join(light, (F.col("_spread") == F.col("_none")) & equal("_r_", "_l_"), "left")
    if how == "inner":
        both = both.filter(F.col("_hot") | F.col("_none").isNotNull())
    return both.select(*[F.col(f"`_r_{c}`").alias(c) for c in rows.columns],
                       *[F.when(F.col("_hot"), F.col(f"`_h_{c}`")).otherwise(F.col(f"`_l_{c}`")).alias(c) for c in more])
