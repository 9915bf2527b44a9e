"""Line dedup by distinct-site spread, DataFrame functions only.

A line's spread is the number of distinct sites that hold it.  HyperLogLog
sketches per line hash merge by aggregation; lines whose estimate lies near
the threshold are counted exactly.  Lines on at least ``min_sites`` sites are
boilerplate and leave every document.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import free_name
from keelson.session import cut_lineage


# Tasks that the documents of one line are dealt to.
SALTS = 32


def line_table(docs: DataFrame, site: str = "source", text: str = "text") -> DataFrame:
    """(h1, h2, site) for every non-blank line; lines compare after trimming."""
    lines = (docs.filter(F.col(site).isNotNull())
             .select(F.col(site).alias("site"), F.explode(F.split(text, "\n")).alias("line"))
             .withColumn("line", F.trim("line")).filter("line != ''"))
    return lines.select(F.expr("xxhash64(1, line)").alias("h1"),
                        F.expr("xxhash64(2, line)").alias("h2"), "site")


def boilerplate_lines(docs: DataFrame, min_sites: int = 10, lg_k: int = 12,
                      sigmas: float = 4.0, site: str = "source", text: str = "text") -> DataFrame:
    """(h1, h2, exact) of lines held by at least ``min_sites`` distinct sites.

    A 128-bit hash stands for a line.  The sketch's relative error is
    ``1.04 / sqrt(2^lg_k)``; estimates within ``sigmas`` errors (and at least
    one site) of the threshold are replaced by exact distinct counts.
    """
    lines = line_table(docs, site, text)
    margin = max(1.0, min_sites * sigmas * 1.04 / math.sqrt(2 ** lg_k))
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("est"))
    seen = cut_lineage(spread.filter(F.col("est") >= min_sites - margin))
    near = seen.filter(F.col("est") <= min_sites + margin).select("h1", "h2")
    # distinct first: a line of many documents shrinks to its sites on the map
    # side, before its hash brings it to one task
    exact = (lines.distinct().join(near, ["h1", "h2"], "left_semi")
             .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") >= min_sites).select("h1", "h2", F.lit(True).alias("exact")))
    sure = seen.filter(F.col("est") > min_sites + margin).select("h1", "h2", F.lit(False).alias("exact"))
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = 10, lg_k: int = 12, sigmas: float = 4.0,
                       key: str = "doc_id", site: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, plus ``n_lines`` and
    ``n_removed``.

    A null text stays null (0 lines); an empty text has 0 lines; blank lines
    stay and don't count.  A null site adds nothing to a line's spread, but
    its documents are cleaned too.  Rows with the same id are cleaned each by
    itself.  Columns named n_lines or n_removed are replaced.
    """
    bad = boilerplate_lines(docs, min_sites, lg_k, sigmas, site, text).select("h1", "h2")
    own, cuts, left = (free_name(docs, n) for n in ("_key", "_cut", "_kept"))
    held = (docs.select(F.col(key).alias("_key"), F.explode(F.split(text, "\n")).alias("line"))
            .withColumn("line", F.trim("line")).filter("line != ''")
            .select("_key", F.expr("xxhash64(1, line)").alias("h1"), F.expr("xxhash64(2, line)").alias("h2")))
    # a frequent line is dealt to SALTS tasks by its documents
    salted = bad.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cut = (held.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int"))
           .join(salted, ["h1", "h2", "_salt"], "left_semi")
           .groupBy("_key").agg(F.collect_set(F.struct("h1", "h2")).alias(cuts)).withColumnRenamed("_key", own))
    d = docs.drop("n_lines", "n_removed")
    j = d.join(cut, d[key].eqNullSafe(cut[own]), "left").drop(own)
    kept = F.expr(f"filter(split(`{text}`, '\\n'), l -> NOT array_contains({cuts}, "
                  "struct(xxhash64(1, trim(l)) AS h1, xxhash64(2, trim(l)) AS h2)))")
    lines = F.split(text, "\n")
    return (j.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(
                F.size(F.filter(lines, lambda x: F.trim(x) != ""))))
            .withColumn(left, F.when(F.col(cuts).isNotNull(), kept))
            .withColumn("n_removed", F.when(F.col(left).isNull(), 0).otherwise(
                F.size(lines) - F.size(left)))
            .withColumn(text, F.when(F.col(left).isNull(), F.col(text)).otherwise(
                F.array_join(left, "\n")))
            .drop(cuts, left))
