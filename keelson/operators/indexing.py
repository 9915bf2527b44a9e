"""Ordering helpers that stay distributed.

* ``global_row_index`` numbers rows in a total order without a single-task
  window: the frame is range-partitioned and sorted, checkpointed so that its
  layout is fixed, and each row gets ``offset[partition] + position``.  Only
  one count per partition reaches the driver.
* ``top_k_per_group`` relies on Spark's window group limit (a partial
  per-map-task limit before the shuffle), so a hot group ships at most
  ``k`` rows per input partition.
* Join sides carry no hint: the planner broadcasts by size in bytes, and AQE
  by the size it measured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.session import cut_lineage

def global_row_index(df: DataFrame, order: Sequence[Column | str], name: str = "rn",
                     start: int = 1) -> DataFrame:
    """Add a dense 1-based (by default) row number in ``order``.

    ``order`` must be a total order (append a unique key as tie breaker)."""
    ordered = cut_lineage(df.orderBy(*order))
    pid = F.spark_partition_id()
    counts = {r["pid"]: r["n"] for r in
              ordered.groupBy(pid.alias("pid")).agg(F.count(F.lit(1)).alias("n")).collect()}
    nparts = ordered.rdd.getNumPartitions()
    offsets, acc = [], start
    for p in range(nparts):
        offsets.append(acc)
        acc += counts.get(p, 0)
    offset_arr = F.array(*[F.lit(int(o)).cast("long") for o in offsets])
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    return ordered.withColumn(name, F.element_at(offset_arr, pid + 1) + local)


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                    k: int, rank_name: str = "rank") -> DataFrame:
    """Rows ranked 1..k inside each group (``order`` must be total).

    The ``row_number() <= k`` filter is planned as a WindowGroupLimit: a
    partial limit runs before the shuffle, so each group receives at most
    k rows per map task however skewed the group sizes are."""
    if not group_cols:
        return top_k(df, order, k, rank_name)
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (df.withColumn(rank_name, F.row_number().over(w))
            .filter(F.col(rank_name) <= k))


def top_k(df: DataFrame, order: Sequence[Column], k: int, rank_name: str = "rank") -> DataFrame:
    """Global top-k: ``orderBy().limit()`` plans as TakeOrderedAndProject
    (per-partition top-k, then a k-row merge)."""
    top = df.orderBy(*order).limit(k)
    w = Window.orderBy(*order)
    return top.withColumn(rank_name, F.row_number().over(w))
