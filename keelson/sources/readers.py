"""Sources (S1-S6, S8-S9): every reader is a plain ``spark.read`` with an
explicit schema, so Catalyst prunes columns and pushes filters to the
scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_numeric_csv(spark: SparkSession, path: str, names: Sequence[str],
                     types: Sequence[str] | None = None) -> DataFrame:
    """Header-less comma file -> named numeric columns (no inference)."""
    types = types or ["double"] * len(names)
    ddl = ", ".join(f"{n} {t}" for n, t in zip(names, types))
    return spark.read.schema(ddl).option("header", "false").csv(path)


def read_feature_table(spark: SparkSession, path: str, features: Sequence[str],
                       label: str | None = None, keep: Sequence[str] = (),
                       label_as: str | None = None, as_array: str | None = None) -> DataFrame:
    """Parquet feature table -> (keep.., features.., label) or with the
    features packed into one ``array<double>`` column named ``as_array``."""
    df = spark.read.parquet(path)
    feats = [F.col(c).cast("double").alias(c) for c in features]
    if as_array:
        feats = [F.array(*[F.col(c).cast("double") for c in features]).alias(as_array)]
    cols = [*keep, *feats]
    if label is not None:
        cols.append(F.col(label).alias(label_as or label))
    return df.select(*cols)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """S3: 'idx<TAB>word' file -> (idx, word)."""
    return spark.read.schema("idx int, word string").option("sep", "\t").csv(path)


def parse_item_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """S4: 'id title..' lines -> (item_id, title): first token is the id,
    the rest (trimmed) is the title.  An id that is no number and a missing
    title are null."""
    parts = F.split(F.trim(F.col(value)), " ", 2)
    return lines.select(F.get(parts, 0).try_cast("bigint").alias("item_id"),
                        F.trim(F.get(parts, 1)).alias("title"))


def read_item_names(spark: SparkSession, path: str) -> DataFrame:
    return parse_item_lines(spark.read.text(path))


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """Whole files -> (path, text), one row per file."""
    return (spark.read.text(path, wholetext=True)
            .select(F.input_file_name().alias("path"), F.col("value").alias("text")))


def read_labelled_tree(spark: SparkSession, root: str, limit_per_class: int | None = None,
                       glob: str = "*") -> DataFrame:
    """<root>/<category>/<file> -> (path, content, category, label, name).

    The label is the category's index in sorted order; ``limit_per_class``
    keeps exactly that many files per category (first by name)."""
    from keelson.operators.features import classes_table
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(root))
    category = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("category")
    name = F.regexp_extract("path", r"/([^/]+)$", 1).alias("name")
    paths = files.select("path", category, name)
    cats = classes_table(paths, "category").select(
        F.col("class").alias("category"), F.col("class_index").alias("label"))
    if limit_per_class is None:
        out = files.select("path", "content", category, name).join(cats, "category")
    else:  # only paths are ranked; the files' bytes come in at the end
        kept = limit_per_group(paths, ["category"], [F.col("name"), F.col("path")], limit_per_class)
        out = files.select("path", "content").join(kept.join(cats, "category"), "path")
    return out.select("category", "path", "content", "name", "label")


def limit_per_group(df: DataFrame, group_cols: Sequence[str], order, limit: int) -> DataFrame:
    """Cap each group at exactly ``limit`` rows (first in ``order``)."""
    from keelson.operators.indexing import top_k_per_group
    return top_k_per_group(df, group_cols, order, limit, rank_name="_rank").drop("_rank")


def json_fields(df: DataFrame, json_col: str, ddl: str, keep: Sequence[str] = ()) -> DataFrame:
    """JSON text -> typed columns (``from_json`` with a DDL schema)."""
    parsed = F.from_json(F.col(json_col), ddl)
    return df.select(*keep, parsed.alias("_j")).select(*keep, "_j.*")


def to_json_column(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
                   out: str = "json") -> DataFrame:
    """Columns -> JSON object text."""
    return df.select(*keep, F.to_json(F.struct(*cols)).alias(out))
