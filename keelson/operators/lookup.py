"""Look-up of the entries of lists in a table of terms.

Rows with a list of terms are dealt to blocks once and stay there; a table says
which blocks hold each term.  A look-up ships each block the values of its own
terms, once a block and term, and finds them there: the entries themselves,
often a hundred times as many, are never shuffled by term, and a frequent term
costs one row a block."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.session import cut_lineage, cut_partitioned

# Between the terms of a written row: a list of short strings takes three times
# the room of their text.
SEP = "\n"
# Entries of a block.
BLOCK_ENTRIES = 2_000_000
# Repeated ids that are broadcast; more are joined by shuffle.
FEW_IDS = 500_000


def counted_list(df: DataFrame, entries: Column, terms: str = "terms", n: str = "n") -> DataFrame:
    """``df`` with the sorted distinct entries of a list and how often each
    occurs there: two lists, empty for a null list."""
    s, at = F.col("_s"), F.col("_at")
    new = F.filter(F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0))),
                   lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    ends = F.concat(F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), F.array(F.size(s)))
    kept = [c for c in df.columns if c not in (terms, n)]
    return (df.withColumn("_s", F.sort_array(entries))
            .withColumn("_at", F.when(F.size(s) > 0, new).otherwise(F.array().cast("array<int>")))
            .select(*kept, F.transform(at, lambda i: F.get(s, i)).alias(terms),
                    F.when(F.size(at) > 0, F.zip_with(at, ends, lambda a, b: b - a)).otherwise(F.array().cast("array<int>")).alias(n)))


def joined(terms: str = "terms") -> Column:
    return F.array_join(terms, SEP)


def parted(terms: str = "terms") -> Column:
    """The list that :func:`joined` wrote as one text."""
    return F.when(F.col(terms) == "", F.array().cast("array<string>")).otherwise(F.split(terms, SEP))


def split_repeated(df: DataFrame, id_col: str, counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose id no other row has, the rest or None).  Only ids are counted
    (in ``counted``, else ``df``) and shuffled; a null id is one like any other."""
    ids = cut_lineage((df if counted is None else counted).groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows"))
                      .filter(F.col("_rows") > 1).select(F.col(id_col).alias("_id")))
    found = ids.count()
    if not found:
        return df, None
    ids = F.broadcast(ids) if found <= FEW_IDS else ids
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    return df.join(ids, same, "left_anti"), df.join(ids, same, "left_semi")


@dataclass
class Dealt:
    """``rows`` (block, the columns given, terms, n), dealt by block, the terms of
    a row as one text, and ``held`` (term, df, n, blocks): ids and occurrences of
    each term."""
    rows: DataFrame
    held: DataFrame


def deal(lists: DataFrame, entries: int, id_col: str = "doc_id", distinct: bool = True) -> Dealt:
    """Rows (id, terms, n, ..) in blocks; ``entries``: about how many there are.
    With ``distinct`` each id has one row and a row's terms differ; else lists
    ``terms`` hold repeats (no ``n``) and ids may come more than once.  Terms are
    not empty and hold no newline; a list may be empty."""
    blocks = max(lists.sparkSession.sparkContext.defaultParallelism, -(-entries // BLOCK_ENTRIES))
    texts = lists.withColumn("terms", joined())
    rows = cut_partitioned(texts.withColumn("block", F.pmod(F.xxhash64(id_col, "terms"), F.lit(blocks)).cast("int")), blocks, "block")
    pairs = rows.withColumn("terms", parted()) if distinct else counted_list(rows.select("block", "terms", id_col), parted())
    once, more = (pairs, None) if distinct else split_repeated(pairs, id_col, rows)
    each = F.inline(F.arrays_zip("terms", "n")).alias("term", "n")
    per = lambda df, ids: df.select("block", each).groupBy("block", "term").agg(ids.alias("df"), F.sum("n").alias("n"))
    held = per(once, F.count(F.lit(1)))
    if more is not None:
        # terms of a repeated id count once for it
        of_id = more.select(id_col, F.explode("terms").alias("term")).distinct().groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        held = held.unionByName(per(more, F.lit(0).cast("long"))).unionByName(
            of_id.select(F.lit(None).cast("int").alias("block"), "term", "df", F.lit(0).cast("long").alias("n")))
    held = held.groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"), F.collect_set("block").alias("blocks"))
    return Dealt(rows, cut_lineage(held))


def look_up(dealt: Dealt, values: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of the rows, and for each column of ``values`` (term,
    v, ..; terms unique, of plain types) a list v of the values of the row's
    terms, null where a term has none."""
    import pyarrow as pa
    import pyarrow.compute as pc

    names = [c for c in values.columns if c not in ("term", "blocks")]
    if "blocks" not in values.columns:
        values = values.join(dealt.held.select("term", "blocks"), "term")
    sent = values.select(F.explode("blocks").alias("block"), "term", *names)
    of = {f.name: f.dataType.simpleString() for f in [*dealt.rows.schema, *values.schema]}

    def whole(c):
        c = c.combine_chunks()
        return pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        text = whole(docs["terms"])
        some = pc.greater(pc.binary_length(text), 0)
        terms = pc.split_pattern(text.filter(some), SEP)
        size = np.zeros(len(text), np.int64)
        size[some.to_numpy(zero_copy_only=False)] = pc.list_value_length(terms).to_numpy()
        ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
        at = pc.index_in(terms.flatten(), value_set=whole(found["term"]))
        more = [pa.ListArray.from_arrays(ends, whole(found[v]).take(at)) for v in names]
        return pa.table([docs[c] for c in keep] + more, names=[*keep, *names])

    schema = ", ".join([f"`{c}` {of[c]}" for c in keep] + [f"`{v}` array<{of[v]}>" for v in names])
    rows = dealt.rows.select("block", *dict.fromkeys([*keep, "terms"]))
    return rows.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(run, schema)
