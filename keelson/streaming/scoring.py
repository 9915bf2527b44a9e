"""Scoring streams with fitted models (Structured Streaming).

A fitted model in this library is a set of literal column expressions, so
the same functions score a streaming DataFrame: no state is needed for
scoring.  ``outlier_counts`` adds event-time state: a watermark and a
tumbling window count the anomalies (density below epsilon) per window,
dropping late rows beyond the watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keelson.operators import anomaly as AN
from keelson.operators import features as FT
from keelson.operators import kmeans as KM
from keelson.operators import linear as LR


def parquet_stream(spark: SparkSession, path: str, schema, max_files: int = 1) -> DataFrame:
    """A file-source stream over a folder of Parquet files."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(path))


def score_linear(stream: DataFrame, normaliser: FT.Normalizer, theta: Sequence[float],
                 out: str = "y_hat") -> DataFrame:
    """Z2 + L1 on a stream: normalise with the fitted statistics, then
    predict with the fitted coefficients."""
    z = FT.normalize(stream, normaliser, suffix="_z")
    return z.withColumn(out, LR.hypothesis([c + "_z" for c in normaliser.cols], theta))


def assign_clusters(stream: DataFrame, features: str, centroids) -> DataFrame:
    """K2 on a stream (expression path; centroids are a bounded model)."""
    return KM.assign(stream, features, centroids)


def flag_anomalies(stream: DataFrame, cols: Sequence[str], mu, var, eps: float) -> DataFrame:
    """A2 + P3 on a stream: density below epsilon."""
    lp = AN.log_density(cols, mu, var)
    return stream.withColumn("p", F.exp(lp)).withColumn("anomaly", F.col("p") < F.lit(eps))


def outlier_counts(flagged: DataFrame, ts: str, window: str = "1 hour",
                   watermark: str = "2 hours") -> DataFrame:
    """Anomalies and rows per event-time window, with a watermark bounding
    the state kept for late data."""
    if flagged.schema[ts].dataType.typeName() != "timestamp":
        flagged = flagged.withColumn(ts, F.col(ts).cast("timestamp"))
    return (flagged.withWatermark(ts, watermark)
            .groupBy(F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(F.col("anomaly").cast("long")).alias("anomalies"))
            .select(F.col("w.start").alias("window_start"), "rows", "anomalies"))


def start(df: DataFrame, name: str, checkpoint: str, mode: str = "append",
          sink: str = "memory") -> StreamingQuery:
    """Start a query; the checkpoint folder must be on shared storage on a
    cluster (it makes the query restartable after failures)."""
    return (df.writeStream.format(sink).queryName(name).outputMode(mode)
            .option("checkpointLocation", checkpoint).start())
