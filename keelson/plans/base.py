"""Registry of queries: each key pairs a Spark callable with oracle SQL.

Outputs are rounded the same way on both sides (``round(x, d) + 0.0`` so
that -0.0 becomes 0.0) so that results compare exactly across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@dataclass
class Query:
    key: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``; ``sql`` is
    the DuckDB oracle (None for randomised / iterative operators)."""
    def deco(fn):
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r(c: Column | str, d: int = 6) -> Column:
    """Spark side of the shared rounding rule."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), d) + F.lit(0.0)


def rs(expr: str, d: int = 6) -> str:
    """SQL side of the shared rounding rule."""
    return f"(round(CAST({expr} AS DOUBLE), {d}) + 0.0)"
