"""Text to features.

Normalisation and tokenisation are chained built-in string functions (one
narrow stage).  Stemming runs once per DISTINCT token (an Arrow-batched
pandas UDF over the vocabulary) and is joined back.  Counts, document
frequencies, TF-IDF norms and naive Bayes sums are grouped aggregates with
map-side combining.  Joins by term keep the few terms that hold much of the
corpus apart (:mod:`keelson.operators.joins`): no task gets all rows of one."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from keelson.functions.expr import col
from keelson.operators.indexing import global_row_index
from keelson.operators.joins import join_skewed
from keelson.operators.lookup import Dealt, counted_list, deal, look_up, parted, split_repeated
from keelson.session import cut_lineage

# The normalisation chain of the spam exercise, in order.
WS_CLASS = r"[^ \t\n\r\f]"
NORMALISE_RULES = [
    (r"<[^<>]+>", " "),
    (r"[0-9]+", "number"),
    (r"(http|https)://" + WS_CLASS + "*", "httpaddr"),
    (WS_CLASS + "+@" + WS_CLASS + "+", "emailaddr"),
    (r"[$]+", "dollar"),
]
# The same rules as they run here: an address match always begins where a run
# without blanks begins; saying so keeps long runs linear.
ANCHORED_RULES = [("(?<!" + WS_CLASS + ")" + p if rep == "emailaddr" else p, rep) for p, rep in NORMALISE_RULES]
# Fixed value: token delimiters of the spam exercise (plus newline, return).
DELIMITERS = r"[ @$/#.\-:&*+=\[\]?!(){},'" + '"' + r">_<;%\n\r]"
NON_ALNUM = r"[^a-zA-Z0-9]"
# characters that are neither alphanumeric nor delimiters
KEEP_CLASS = r"[^a-zA-Z0-9 @$/#.\-:&*+=\[\]?!(){},'" + '"' + r">_<;%\n\r]"
# Fixed value: word pattern of the count vectoriser (runs of >= 2 word chars).
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def spread(df: DataFrame) -> DataFrame:
    """Regex work over whole texts is CPU-bound and rows are large: when a
    scan yields fewer partitions than the cluster has task slots (a few big
    row groups), spread the rows round-robin first.  At scale the scan
    already has many more splits than slots and nothing is shuffled."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def normalise(text: Column | str) -> Column:
    """Lower case, strip tags, numbers -> 'number', URLs -> 'httpaddr',
    e-mail addresses -> 'emailaddr', dollar signs -> 'dollar'."""
    out = F.lower(col(text))
    for pat, rep in ANCHORED_RULES:
        out = F.regexp_replace(out, pat, rep)
    return out


def tokenise(text: Column | str) -> Column:
    """Split on the delimiter set, drop non-alphanumerics, drop empty
    tokens -> array<string> in text order.

    Computed as ONE whole-text replace of the characters that are neither
    alphanumeric nor delimiters, then a split: removing such characters
    never merges two tokens (the delimiters stay), so this equals
    stripping every token separately, without a per-token lambda."""
    cleaned = F.regexp_replace(col(text), KEEP_CLASS, "")
    return F.filter(F.split(cleaned, DELIMITERS + "+"), lambda t: F.length(t) > 0)


def token_rows(df: DataFrame, id_col: str, text: str, normalised: bool = True) -> DataFrame:
    """(id, pos, token) rows, pos 0-based, over the whole text."""
    src = normalise(text) if normalised else col(text)
    return spread(df).select(id_col, F.posexplode(tokenise(src)).alias("pos", "token"))


def step1a(t: Column | str) -> Column:
    """T3 step 1a: sses -> ss, ies -> i, ss -> ss, s -> ''."""
    t = col(t)
    return (F.when(t.endswith("sses"), F.regexp_replace(t, "sses$", "ss"))
            .when(t.endswith("ies"), F.regexp_replace(t, "ies$", "i"))
            .when(t.endswith("ss"), t)
            .when(t.endswith("s"), F.regexp_replace(t, "s$", ""))
            .otherwise(t))


# Stems that a Python worker remembers.
STEMS_KEPT = 1_000_000
_stems: dict[str, str] = {}


def _stemmed(words):
    """Stems of a pandas series; a worker stems each distinct word about once."""
    from keelson.functions.porter import stem
    if len(_stems) > STEMS_KEPT:
        _stems.clear()
    codes, distinct = words.factorize()
    for w in distinct:
        if w not in _stems:
            _stems[w] = stem(w)
    return words.map(_stems)


@F.pandas_udf(StringType())
def porter_udf(words: pd.Series) -> pd.Series:
    return _stemmed(words)


@F.pandas_udf(ArrayType(StringType()))
def porter_lists_udf(lists: pd.Series) -> pd.Series:
    """The stems of lists of words."""
    size = lists.map(len).to_numpy(dtype=int)
    flat = pd.Series([w for words in lists for w in words], dtype=object)
    stems = _stemmed(flat).to_numpy()
    ends = size.cumsum()
    return pd.Series([stems[e - n:e] for e, n in zip(ends, size)], dtype=object)


def stem_tokens(tokens: DataFrame, token_col: str = "token", out: str = "stem",
                full: bool = True) -> DataFrame:
    """T3 on token rows, without a shuffle: stems are looked up in a worker's
    memory.  ``full=False`` applies only step 1a (a pure expression)."""
    return tokens.withColumn(out, porter_udf(F.col(token_col)) if full else step1a(token_col))


def stem_lists(df: DataFrame, id_col: str, text: str, full: bool = True, out: str = "terms") -> DataFrame:
    """(id, terms): the stemmed tokens of every text in order, as a list."""
    tokens = F.coalesce(tokenise(normalise(text)), F.array().cast("array<string>"))
    stems = porter_lists_udf(tokens) if full else F.transform(tokens, step1a)
    return spread(df).select(id_col, stems.alias(out))


def distinct_stems(tokens: DataFrame, token_col: str = "token", out: str = "stem") -> DataFrame:
    """(token, stem) of the distinct tokens."""
    return tokens.select(token_col).distinct().select(token_col, porter_udf(F.col(token_col)).alias(out))


def build_vocab(terms: DataFrame, term_col: str = "term", id_col: str | None = None,
                min_df: int = 1, start: int = 0, out: str = "idx") -> DataFrame:
    """Sorted distinct terms -> dense index (``start``-based).  With
    ``min_df`` > 1 a term must occur in that many distinct ids.  The index
    is assigned by a distributed global row number (no single-task sort)."""
    if min_df > 1 and id_col is not None:
        d = (terms.select(id_col, term_col).distinct().groupBy(term_col)
             .agg(F.count(F.lit(1)).alias("_df")).filter(F.col("_df") >= min_df)
             .select(term_col))
    else:
        d = terms.select(term_col).distinct()
    return global_row_index(d, [term_col], name=out, start=start).select(term_col, out)


def vocabulary(dealt: Dealt, min_df: int = 1, start: int = 0, out: str = "idx") -> DataFrame:
    """T8 as :func:`build_vocab`, of the terms that a :class:`Dealt` holds:
    (term, blocks, idx)."""
    terms = dealt.held.filter(F.col("df") >= min_df).select("term", "blocks")
    return global_row_index(terms, ["term"], name=out, start=start)


def word_lists(dealt: Dealt, vocab: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """T4 by document: (id, idx), the list of the vocabulary's numbers of its
    tokens, null where a token is unknown."""
    return look_up(dealt, vocab, [id_col])


def word_indices(dealt: Dealt, vocab: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """T4: look each token up in the vocabulary (term, idx; unique terms); unknown
    tokens drop out, order and repeats are kept (id, pos, idx)."""
    return (word_lists(dealt, vocab, id_col).select(id_col, F.posexplode("idx").alias("pos", "idx"))
            .filter(F.col("idx").isNotNull()))


def term_presence(lists: DataFrame, id_col: str = "doc_id", idx: str = "idx", counted: DataFrame | None = None) -> DataFrame:
    """Binary term vector as distinct (doc, idx) rows, plus the
    number of non-zero entries per document, from (id, list of numbers) rows.
    Only rows that share an id (counted in ``counted``, cheaper to read) are
    shuffled; a null id has no vector."""
    lists = lists.filter(F.col(id_col).isNotNull())
    once, more = split_repeated(lists, id_col, counted)
    has = F.array_distinct(F.filter(idx, lambda i: i.isNotNull()))
    out = (once.select(id_col, has.alias("_has")).select(id_col, "_has", F.size("_has").cast("long").alias("n_nonzero"))
           .select(id_col, F.explode("_has").alias(idx), "n_nonzero"))
    if more is None:
        return out
    pres = more.select(id_col, F.explode(has).alias(idx)).distinct()
    nnz = pres.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_nonzero"))
    return out.unionByName(pres.join(nnz, id_col))


def words(text: Column | str, lowercase: bool = True) -> Column:
    """T7 tokens: runs of >= 2 word characters (letters, digits, _)."""
    t = F.lower(col(text)) if lowercase else col(text)
    return F.regexp_extract_all(t, F.lit(WORD_PATTERN), 0)


def _grams(w: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` consecutive words, joined by one blank."""
    def runs(n: int) -> Column:
        if n == 1:
            return w
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1)))
        if n == 2:
            pair = lambda i: F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1))
        else:
            pair = lambda i: F.array_join(F.slice(w, i, n), " ")
        return F.when(F.size(w) >= n, F.transform(starts, pair)).otherwise(F.array().cast("array<string>"))

    return F.concat(*[runs(n) for n in range(low, high + 1)]) if high > low else runs(low)


def _row_counts(df: DataFrame, id_col: str, text: str, low: int, high: int) -> DataFrame:
    """(id, terms, n) of every row: the counts of its own text."""
    rows = spread(df).select(id_col, words(text).alias("_w"))
    return counted_list(rows, _grams(F.col("_w"), low, high)).select(id_col, "terms", "n")


def _long(lists: DataFrame, id_col: str, out: str = "term") -> DataFrame:
    return lists.select(id_col, F.inline(F.arrays_zip("terms", "n")).alias(out, "n")).withColumn("n", F.col("n").cast("long"))


def ngram_counts(df: DataFrame, id_col: str, text: str, low: int = 1, high: int = 2, out: str = "term") -> DataFrame:
    """T7 with an n-gram range: (doc, term, n) of all runs of ``low`` to
    ``high`` consecutive words, joined by one blank.  Each text is counted in its
    own row; only rows that share an id are shuffled and added."""
    once, more = split_repeated(df.select(id_col, text), id_col)
    counts = _long(_row_counts(once, id_col, text, low, high), id_col, out)
    if more is None:
        return counts
    return counts.unionByName(_long(_row_counts(more, id_col, text, low, high), id_col, out)
                              .groupBy(id_col, out).agg(F.sum("n").alias("n")))


def term_counts(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc, term, n) counts."""
    return ngram_counts(df, id_col, text, 1, 1)


def bigram_counts(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """T7 with ngram (2, 2): consecutive word pairs 'a b' per document."""
    return ngram_counts(df, id_col, text, 2, 2, "bigram")


def count_lists(df: DataFrame, id_col: str, text: str, low: int = 1, high: int = 1) -> DataFrame:
    """:func:`ngram_counts` with one row an id: (doc, terms, n), both lists."""
    once, more = split_repeated(df.select(id_col, text), id_col)
    lists = _row_counts(once, id_col, text, low, high)
    if more is None:
        return lists
    return lists.unionByName(listed(_long(_row_counts(more, id_col, text, low, high), id_col)
                                    .groupBy(id_col, "term").agg(F.sum("n").alias("n")), id_col)
                             .withColumn("n", F.col("n").cast("array<int>")))


def listed(counts: DataFrame, id_col: str = "doc_id", term: str = "term", n: str = "n") -> DataFrame:
    """(id, term, n) rows as one row an id: (id, terms, n)."""
    pairs = F.collect_list(F.struct(F.col(term).alias("t"), F.col(n).alias("n")))
    return counts.groupBy(id_col).agg(pairs.alias("_e")).select(id_col, F.col("_e.t").alias("terms"), F.col("_e.n").alias("n"))


def n_entries(df: DataFrame, text: str) -> int:
    """About how many words the texts have, from their lengths."""
    return (df.agg(F.sum(F.length(text))).first()[0] or 0) // 6


def idf_values(dealt: Dealt, n_docs: int) -> DataFrame:
    """(term, blocks, idf): ln((1 + N) / (1 + df)) + 1 of every term held."""
    return dealt.held.select("term", "blocks", (F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))) + 1.0).alias("idf"))


def _unit(lists: DataFrame, w: Column, *keep: str) -> DataFrame:
    """Rows with a list ``w`` scaled to unit L2 norm."""
    # The norm is named twice below: an expression named once would be merged into
    # the lambda and evaluated for every entry.
    norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda acc, v: acc + v * v))
    return (lists.select(*keep, w.alias("_w")).withColumn("_norm", norm)
            .withColumn("w", F.transform("_w", lambda v: F.when(F.col("_norm") > 0, v / F.col("_norm")))).select(*keep, "w"))


def tfidf_lists(dealt: Dealt, values: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """T9 by document: (id, terms, w) and a list for each further column of
    ``values`` (see :func:`idf_values`); an id that is null is left out."""
    more = [c for c in values.columns if c not in ("term", "blocks", "idf")]
    found = look_up(dealt, values, [id_col, "terms", "n"]).filter(F.col(id_col).isNotNull())
    return _unit(found.withColumn("terms", parted()), F.zip_with("n", "idf", lambda n, v: n * v), id_col, "terms", *more)


def tfidf(counts: DataFrame, n_docs: int, id_col: str = "doc_id", term: str = "term",
          n: str = "n", use_idf: bool = True) -> DataFrame:
    """Tf * (ln((1 + N) / (1 + df)) + 1), rows scaled to unit L2 norm, from
    (doc, term, n) rows of distinct terms (not empty, without newlines).  They are
    gathered by document once; idf goes to the documents' blocks."""
    lists = listed(counts.filter(F.col(term).isNotNull()), id_col, term, n)
    if use_idf:
        lists = cut_lineage(lists)
        dealt = deal(lists, lists.agg(F.sum(F.size("terms"))).first()[0] or 0, id_col)
        out = tfidf_lists(dealt, idf_values(dealt, n_docs), id_col)
    else:
        out = _unit(lists.filter(F.col(id_col).isNotNull()), F.col("n").cast("array<double>"), id_col, "terms")
    return tfidf_rows(out, id_col, term)


def tfidf_rows(lists: DataFrame, id_col: str = "doc_id", term: str = "term") -> DataFrame:
    """(id, term, w) rows of lists."""
    return lists.select(id_col, F.inline(F.arrays_zip("terms", "w")).alias(term, "w"))


def nb_fit(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "label",
           term: str = "term", n: str = "n", alpha: float = 1.0):
    """T10 fit: multinomial naive Bayes on (doc, term, n) for labelled docs.

    ``counts`` may also be lists (doc, terms, n).  Returns (model, priors, classes): the model has one row per vocabulary term
    with the log probabilities c0, c1, .. = ln((N_ct + alpha) / (N_c + alpha V))
    in the order of ``classes``; priors are the log priors in that order.  The
    per-class sums of each term are written once and give vocabulary size,
    class totals and the model.  Rows without a label don't count; classes are
    a model's size."""
    lab = labels.select(id_col, F.col(label).alias("class")).filter(F.col("class").isNotNull())
    per = {r["class"]: r["nd"] for r in lab.groupBy("class").agg(F.count(F.lit(1)).alias("nd")).collect()}
    classes = sorted(per)
    priors = [math.log(per[c] / sum(per.values())) for c in classes]
    sums = [F.sum(F.when(F.col("class") == F.lit(c), F.col(n)).otherwise(F.lit(0))).alias(f"c{i}")
            for i, c in enumerate(classes)]
    if not classes:
        return counts.select(term).limit(0), priors, classes
    rows = counts.join(lab, id_col)
    if isinstance(counts.schema[n].dataType, ArrayType):
        rows = rows.select("class", F.inline(F.arrays_zip("terms", n)).alias(term, n))
    wide = cut_lineage(rows.groupBy(term).agg(*sums))
    tot = wide.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(classes))]).first()
    model = wide.select(term, *[F.log((F.col(f"c{i}") + F.lit(alpha))
                                      / F.lit(float((tot[f"c{i}"] or 0) + alpha * tot["v"]))).alias(f"c{i}")
                                for i in range(len(classes))])
    return model, priors, classes


def nb_rows(model: DataFrame, priors: Sequence[float], classes: Sequence, term: str = "term") -> DataFrame:
    """The model in long form: (class, term, log_prob, log_prior)."""
    return model.select(term, F.inline(F.array(*[
        F.struct(F.lit(c).alias("class"), F.col(f"c{i}").alias("log_prob"), F.lit(p).alias("log_prior"))
        for i, (c, p) in enumerate(zip(classes, priors))]))).select("class", term, "log_prob", "log_prior")


def nb_predict(docs: DataFrame, counts: DataFrame, model: DataFrame, priors: Sequence[float],
               classes: Sequence, id_col: str = "doc_id", term: str = "term",
               n: str = "n") -> DataFrame:
    """T10 predict: argmax_c log prior_c + sum_t n_t log theta_ct over the
    model's vocabulary (other terms ignored); ties -> first class."""
    sums = join_skewed(counts, model, [term], "inner").groupBy(id_col).agg(
        *[F.sum(F.col(n) * F.col(f"c{i}")).alias(f"_s{i}") for i in range(len(classes))])
    return _nb_best(docs, sums, priors, classes, id_col)


def nb_predict_lists(docs: DataFrame, lists: DataFrame, priors: Sequence[float], classes: Sequence,
                     id_col: str = "doc_id", n: str = "n") -> DataFrame:
    """:func:`nb_predict` from one row an id: (doc, n, c0, c1, ..), the lists of
    its terms' weights and log probabilities (null: not in the model)."""
    dot = [F.aggregate(F.zip_with(n, f"c{i}", lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda acc, v: acc + v)
           .alias(f"_s{i}") for i in range(len(classes))]
    return _nb_best(docs, lists.select(id_col, *dot), priors, classes, id_col)


def _nb_best(docs: DataFrame, sums: DataFrame, priors: Sequence[float], classes: Sequence, id_col: str) -> DataFrame:
    post = F.array(*[F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) + F.lit(p) for i, p in enumerate(priors)])
    best = F.array_max(post)
    cls = F.element_at(F.array(*[F.lit(c) for c in classes]), F.array_position(post, best).cast("int"))
    return (docs.select(id_col).join(sums, id_col, "left")
            .select(id_col, cls.alias("pred"), best.alias("score")))
