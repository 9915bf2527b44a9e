"""Session construction and lineage control.

Iterative fits (k-means, alternating least squares, network training, the
sparse linear trainer) cut their lineage with a *reliable* checkpoint in the
shared folder named by ``spark.checkpoint.dir``.  The cluster sets that
folder; only a local session (tests, bench) gets a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(master: str | None = None, partitions: int | None = None,
                app: str = "keelson") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.  Master, shuffle
    partitions and memory are the cluster's (spark-submit's) unless given;
    KEELSON_MASTER names a master for runs outside of it."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    master = master or os.environ.get("KEELSON_MASTER")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the context's, else the one that
    spark.checkpoint.dir names.  Only a single-JVM local session without the
    setting gets a scratch folder of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: iterative operators need a "
                "shared folder for reliable checkpoints on a cluster")
        current = tempfile.mkdtemp(prefix="keelson-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors when it isn't installed
    there: a zip of it goes out with the application, once per context."""
    import shutil

    sc = spark.sparkContext
    if getattr(sc, "_keelson_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="keelson-zip-")
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "keelson"), "zip", root, "keelson"))
    sc._keelson_shipped = True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint (survives executor loss).
    With spark.cleaner.referenceTracking.cleanCheckpoints (see get_session) its
    files go when the result is no longer used."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_partitioned(df: DataFrame, parts: int, *keys: str, order: Sequence[str] = ()) -> DataFrame:
    """Like :func:`cut_lineage`, dealt to ``parts`` partitions by ``keys`` and
    sorted there (by ``order`` after them), so that later groupings and joins on them need neither a
    shuffle nor a sort of this side.  An
    adaptive plan doesn't say how its result is partitioned, so this one step
    runs without; its shuffle files go when the result is written.  The settings
    are put back."""
    checkpoint_dir(df.sparkSession)
    conf = df.sparkSession.conf
    own = {"spark.sql.adaptive.enabled": "false", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    before = {k: conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            conf.set(k, v)
        return df.repartition(parts, *keys).sortWithinPartitions(*keys, *order).checkpoint(eager=True)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def release(df: DataFrame) -> None:
    """Delete the files of a frame that :func:`cut_lineage` or :func:`cut_partitioned`
    returned, which nothing will read again; else they stay until the driver
    happens to collect its garbage."""
    sc = df.sparkSession.sparkContext
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        path = sc._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def numbers(spark: SparkSession, blocks: int) -> list[int]:
    """So many block numbers, each dealt to a partition of its own."""
    at, tried = {}, 0
    while len(at) < blocks:
        ids = spark.range(tried, tried := 2 * tried + 16 * blocks, numPartitions=1).select(F.col("id").cast("int").alias("n"))
        for r in ids.groupBy(F.pmod(F.hash("n"), F.lit(blocks)).alias("at")).agg(F.min("n").alias("n")).collect():
            at.setdefault(r["at"], r["n"])
    return [at[i] for i in range(blocks)]
