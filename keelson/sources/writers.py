"""Sinks (S7, S10): prediction tables and fitted models."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def submission_frame(probs: DataFrame, id_col: str, class_col: str, p_col: str,
                     classes: Sequence[str]) -> DataFrame:
    """S7 (frame): long (id, class, p) -> one column per class plus the id.
    The class list is given, so the pivot needs no extra distinct job."""
    return probs.groupBy(id_col).pivot(class_col, list(classes)).agg(F.first(p_col))


def write_submission(frame: DataFrame, out_dir: str, info: str = "") -> str:
    """Write the prediction table as CSV with header in a time-stamped
    folder of its own (writes of the same minute don't meet); returns the path."""
    stamp = time.strftime("%Y-%m-%d-%H-%M")
    path = f"{out_dir.rstrip('/')}/submission_{info}_{stamp}-{uuid.uuid4().hex[:8]}"
    frame.write.mode("error").option("header", "true").csv(path)
    return path


def save_model(table: DataFrame, path: str) -> None:
    """A fitted model is a small table; persist it as Parquet."""
    table.write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
