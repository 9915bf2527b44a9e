"""Text queries (T1-T12, V6) over the whole documents / pages texts;
naive Bayes classes come from labels.quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from keelson.operators import evaluate as EV
from keelson.operators import many_sparse as MS
from keelson.operators import sparse_linear as SL
from keelson.operators import text as TX
from keelson.operators.indexing import top_k
from keelson.operators.lookup import deal
from keelson.plans.base import query, r, rs, table
from keelson.session import cut_lineage


def _s(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def NORM(e: str) -> str:
    return reduce(lambda acc, rule: f"regexp_replace({acc}, {_s(rule[0])}, {_s(rule[1])}, 'g')",
                  TX.NORMALISE_RULES, f"lower({e})")


_TOKLIST = (f"list_filter(list_transform(regexp_split_to_array({NORM('text')}, {_s(TX.DELIMITERS)}), "
            f"lambda x: regexp_replace(x, {_s(TX.NON_ALNUM)}, '', 'g')), lambda x: length(x) > 0)")
_TOKENS = (f"tok AS (SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS pos, "
           f"unnest(t) AS token FROM (SELECT doc_id, {_TOKLIST} AS t FROM documents))")
_STEP1A = ("CASE WHEN ends_with({t}, 'sses') THEN regexp_replace({t}, 'sses$', 'ss') "
           "WHEN ends_with({t}, 'ies') THEN regexp_replace({t}, 'ies$', 'i') "
           "WHEN ends_with({t}, 'ss') THEN {t} "
           "WHEN ends_with({t}, 's') THEN regexp_replace({t}, 's$', '') ELSE {t} END")
_WORDS = f"regexp_extract_all(lower(text), {_s(TX.WORD_PATTERN)})"
_COUNTS = (f"cnt AS (SELECT doc_id, term, count(*) AS n FROM "
           f"(SELECT doc_id, unnest({_WORDS}) AS term FROM documents) GROUP BY doc_id, term)")
_VOCAB_MIN_DF = 2


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _tokens(spark, sf):
    return TX.token_rows(_docs(spark, sf), "doc_id", "text")


def _counts(spark, sf):
    """Term counts, checkpointed: several branches read them, and the regex
    pass over the whole texts then runs once."""
    return cut_lineage(TX.term_counts(_docs(spark, sf), "doc_id", "text"))


def _dealt_counts(spark, sf):
    """Term counts, one row a document, in blocks: the regex pass over the whole
    texts runs once."""
    d = _docs(spark, sf)
    return deal(TX.count_lists(d, "doc_id", "text"), TX.n_entries(d, "text"))


@query("text_normalise", sql=f"SELECT page_id, {NORM('html')} AS text FROM pages")
def text_normalise(spark, sf):
    """Normalise whole web pages (tags, numbers, URLs, addresses, $)."""
    p = table(spark, sf, "pages")
    return p.select("page_id", TX.normalise("html").alias("text"))


@query("tokens", sql=f"WITH {_TOKENS} SELECT doc_id, pos, token FROM tok")
def tokens(spark, sf):
    """(doc_id, pos, token) of every normalised document."""
    return _tokens(spark, sf)


@query("stem_step1a", sql=f"""
WITH {_TOKENS}
SELECT token, {_STEP1A.format(t='token')} AS stem FROM (SELECT DISTINCT token FROM tok)""")
def stem_step1a(spark, sf):
    """T3 step 1a on the distinct tokens."""
    d = _tokens(spark, sf).select("token").distinct()
    return d.select("token", TX.step1a("token").alias("stem"))


@query("porter_stems")
def porter_stems(spark, sf):
    """Full Porter stemmer, run once per distinct token (Arrow UDF)."""
    return TX.distinct_stems(_tokens(spark, sf))


_WI = f"""{_TOKENS},
st AS (SELECT doc_id, pos, {_STEP1A.format(t='token')} AS stem FROM tok),
voc AS (SELECT stem AS word, row_number() OVER (ORDER BY stem) AS idx FROM
        (SELECT stem FROM (SELECT DISTINCT doc_id, stem FROM st) GROUP BY stem
         HAVING count(*) >= {_VOCAB_MIN_DF})),
wi AS (SELECT st.doc_id, st.pos, voc.idx FROM st JOIN voc ON voc.word = st.stem)"""


def _dealt(spark, sf, full=False):
    """The stemmed tokens of every document, in blocks."""
    d = _docs(spark, sf)
    return deal(TX.stem_lists(d, "doc_id", "text", full), TX.n_entries(d, "text"), distinct=False)


def _vocab(dealt):
    """Stems in >= 2 documents, sorted, from 1."""
    return TX.vocabulary(dealt, _VOCAB_MIN_DF, 1)


@query("file_vocab_indices", sql=f"""
WITH {_TOKENS},
st AS (SELECT doc_id, pos, {_STEP1A.format(t='token')} AS stem FROM tok),
voc AS (SELECT stem AS word, row_number() OVER (ORDER BY n DESC, stem) AS idx FROM
        (SELECT stem, count(*) AS n FROM st GROUP BY stem ORDER BY n DESC, stem LIMIT 1899))
SELECT st.doc_id, st.pos, CAST(voc.idx AS INTEGER) AS idx FROM st JOIN voc ON voc.word = st.stem""")
def file_vocab_indices(spark, sf):
    """S3 + T4: a vocabulary file (idx, word) of the 1899 most frequent stems,
    written and read again, and every stemmed token looked up in it."""
    import uuid

    from keelson.session import checkpoint_dir
    from keelson.sources.readers import read_vocab
    dealt = _dealt(spark, sf)
    best = top_k(dealt.held.select("term", "n"), [F.desc("n"), F.col("term")], 1899).select(F.col("rank").alias("idx"), F.col("term").alias("word"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/vocab-{uuid.uuid4().hex}"
    best.coalesce(1).write.option("sep", "\t").csv(path)
    return TX.word_indices(dealt, read_vocab(spark, path).select(F.col("word").alias("term"), "idx")).select("doc_id", "pos", "idx")


@query("porter_word_indices")
def porter_word_indices(spark, sf):
    """T3 + T4: full Porter stems looked up in the vocabulary of stems in >= 2
    documents (sorted, 1-based); unknown tokens dropped."""
    dealt = _dealt(spark, sf, full=True)
    return TX.word_indices(dealt, _vocab(dealt)).select("doc_id", "pos", "idx")


@query("word_indices", sql=f"WITH {_WI} SELECT doc_id, pos, idx FROM wi")
def word_indices(spark, sf):
    """T4: stemmed tokens looked up in the vocabulary built from the corpus
    (stems in >= 2 documents, sorted, 1-based); unknown tokens dropped."""
    dealt = _dealt(spark, sf)
    return TX.word_indices(dealt, _vocab(dealt)).select("doc_id", "pos", "idx")


@query("term_presence", sql=f"""
WITH {_WI}, p AS (SELECT DISTINCT doc_id, idx FROM wi)
SELECT p.doc_id, p.idx, n.n_nonzero FROM p JOIN
  (SELECT doc_id, count(*) AS n_nonzero FROM p GROUP BY doc_id) n ON n.doc_id = p.doc_id""")
def term_presence(spark, sf):
    """Binary term vectors (distinct doc, idx) and non-zeros per doc."""
    dealt = _dealt(spark, sf)
    lists = TX.word_lists(dealt, _vocab(dealt))
    return TX.term_presence(lists, counted=dealt.rows).select("doc_id", "idx", "n_nonzero")


@query("term_counts", sql=f"WITH {_COUNTS} SELECT doc_id, term, n FROM cnt")
def term_counts(spark, sf):
    """Token counts per document (runs of >= 2 word characters)."""
    return TX.term_counts(_docs(spark, sf), "doc_id", "text")


@query("bigram_counts", sql=f"""
SELECT doc_id, bigram, count(*) AS n FROM (
  SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram
  FROM (SELECT doc_id, {_WORDS} AS w FROM documents)) GROUP BY doc_id, bigram""")
def bigram_counts(spark, sf):
    """T7 (ngram 2): consecutive word pairs per document."""
    return TX.bigram_counts(_docs(spark, sf), "doc_id", "text")


@query("ngram_counts", sql=f"""
SELECT doc_id, term, count(*) AS n FROM (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
  FROM (SELECT doc_id, {_WORDS} AS w FROM documents)) GROUP BY doc_id, term""")
def ngram_counts(spark, sf):
    """T7 (n-gram range 1 to 2): words and consecutive word pairs per document."""
    return TX.ngram_counts(_docs(spark, sf), "doc_id", "text", 1, 2)


@query("vocab", sql=f"""
WITH {_COUNTS}
SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM (SELECT DISTINCT term FROM cnt)""")
def vocab(spark, sf):
    """Sorted distinct terms -> 0-based index (distributed numbering)."""
    w = _docs(spark, sf).select(F.explode(TX.words("text")).alias("term"))
    return TX.build_vocab(w, "term", start=0)


@query("tfidf", sql=f"""
WITH {_COUNTS},
d AS (SELECT term, count(*) AS df FROM cnt GROUP BY term),
w AS (SELECT cnt.doc_id, cnt.term, cnt.n * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + d.df)) + 1.0) AS w
      FROM cnt JOIN d ON d.term = cnt.term),
nr AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY doc_id)
SELECT w.doc_id, w.term, {rs('w.w / nr.nrm', 8)} AS w FROM w JOIN nr ON nr.doc_id = w.doc_id""")
def tfidf(spark, sf):
    """Smoothed tf-idf with unit L2 rows."""
    dealt = _dealt_counts(spark, sf)
    lists = TX.tfidf_lists(dealt, TX.idf_values(dealt, table(spark, sf, "documents").count()))
    return TX.tfidf_rows(lists).select("doc_id", "term", r("w", 8).alias("w"))


_NB = f"""{_COUNTS},
lab AS (SELECT doc_id, quality AS class FROM labels),
tr AS (SELECT cnt.doc_id, cnt.term, cnt.n, lab.class FROM cnt JOIN lab ON lab.doc_id = cnt.doc_id),
nct AS (SELECT class, term, sum(n) AS nct FROM tr GROUP BY class, term),
voc AS (SELECT DISTINCT term FROM tr),
cls AS (SELECT DISTINCT class FROM lab),
nc AS (SELECT class, sum(nct) AS nc FROM nct GROUP BY class),
pri AS (SELECT class, ln(count(*) / (SELECT count(*) FROM lab)) AS log_prior FROM lab GROUP BY class),
model AS (SELECT cls.class, voc.term,
            ln((coalesce(nct.nct, 0) + 1.0) / (nc.nc + 1.0 * (SELECT count(*) FROM voc))) AS log_prob
          FROM cls CROSS JOIN voc JOIN nc ON nc.class = cls.class
          LEFT JOIN nct ON nct.class = cls.class AND nct.term = voc.term)"""


def _nb(spark, sf):
    docs = _docs(spark, sf)
    c = _counts(spark, sf)
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    model, priors, classes = TX.nb_fit(c, labels)
    return docs, c, model, priors, classes


@query("nb_model", sql=f"""
WITH {_NB}
SELECT model.class, model.term, {rs('model.log_prob', 8)} AS log_prob, {rs('pri.log_prior', 8)} AS log_prior
FROM model JOIN pri ON pri.class = model.class""")
def nb_model(spark, sf):
    """T10 fit: multinomial naive Bayes (alpha = 1) on labelled documents."""
    _, _, model, priors, classes = _nb(spark, sf)
    return TX.nb_rows(model, priors, classes).select(
        "class", "term", r("log_prob", 8).alias("log_prob"), r("log_prior", 8).alias("log_prior"))


@query("nb_predict", sql=f"""
WITH {_NB},
s AS (SELECT cnt.doc_id, model.class, sum(cnt.n * model.log_prob) AS s
      FROM cnt JOIN model ON model.term = cnt.term GROUP BY cnt.doc_id, model.class),
post AS (SELECT d.doc_id, pri.class, coalesce(s.s, 0.0) + pri.log_prior AS post
         FROM documents d CROSS JOIN pri LEFT JOIN s ON s.doc_id = d.doc_id AND s.class = pri.class),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY post DESC, class) AS rn FROM post)
SELECT doc_id, class AS pred, {rs('post', 6)} AS score FROM best WHERE rn = 1""")
def nb_predict(spark, sf):
    """T10 predict: most probable class for every document."""
    docs, c, model, priors, classes = _nb(spark, sf)
    p = TX.nb_predict(docs, c, model, priors, classes)
    return p.select("doc_id", "pred", r("score", 6).alias("score"))


@query("top_weights", sql=f"""
WITH {_NB},
wt AS (SELECT a.term, a.log_prob - b.log_prob AS weight FROM model a JOIN model b
       ON a.term = b.term AND a.class = 1 AND b.class = 0),
vi AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM (SELECT DISTINCT term FROM cnt)),
t AS (SELECT term, weight FROM wt ORDER BY weight DESC, term LIMIT 15)
SELECT CAST(row_number() OVER (ORDER BY weight DESC, t.term) AS INTEGER) AS rank, t.term, vi.idx,
       {rs('weight', 8)} AS weight
FROM t JOIN vi ON vi.term = t.term""")
def top_weights(spark, sf):
    """V6: the 15 strongest predictors of the positive class (naive Bayes
    log-ratio weights), joined with the vocabulary index."""
    _, c, model, _, classes = _nb(spark, sf)
    lp = {cls: F.col(f"c{i}") for i, cls in enumerate(classes)}
    wt = model.select("term", (lp[1] - lp[0]).alias("weight"))
    best = top_k(wt, [F.col("weight").desc(), F.col("term")], 15)
    vi = TX.build_vocab(c, "term", start=0)
    return best.join(vi, "term").select("rank", "term", "idx", r("weight", 8).alias("weight"))


@query("text_svm")
def text_svm(spark, sf):
    """Linear SVM (hinge, L2, alpha 1e-3) on tf-idf of the labelled
    documents, trained by distributed subgradient descent; returns the
    weight per term."""
    dealt = _dealt_counts(spark, sf)
    w = TX.tfidf_lists(dealt, TX.idf_values(dealt, table(spark, sf, "documents").count()))
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    weights, b, _ = SL.fit_hinge(w, labels, iters=8, entries=TX.n_entries(_docs(spark, sf), "text"))
    return weights.select("term", "weight")


_TFIDF_NB = f"""{_COUNTS},
d AS (SELECT term, count(*) AS df FROM cnt GROUP BY term),
w AS (SELECT cnt.doc_id, cnt.term, cnt.n * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + d.df)) + 1.0) AS w
      FROM cnt JOIN d ON d.term = cnt.term),
nr AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM w GROUP BY doc_id),
tw AS (SELECT w.doc_id, w.term, w.w / nr.nrm AS n FROM w JOIN nr ON nr.doc_id = w.doc_id),
lab AS (SELECT doc_id, quality AS class FROM labels),
nct AS (SELECT class, term, sum(n) AS nct FROM tw JOIN lab ON lab.doc_id = tw.doc_id GROUP BY class, term),
voc AS (SELECT DISTINCT term FROM nct), nc AS (SELECT class, sum(nct) AS nc FROM nct GROUP BY class),
pri AS (SELECT class, ln(count(*) / (SELECT count(*) FROM lab)) AS log_prior FROM lab GROUP BY class),
model AS (SELECT nc.class, voc.term, ln((coalesce(nct.nct, 0) + 1.0) / (nc.nc + 1.0 * (SELECT count(*) FROM voc))) AS log_prob
          FROM nc CROSS JOIN voc LEFT JOIN nct ON nct.class = nc.class AND nct.term = voc.term)"""


@query("text_classify", sql=f"""
WITH {_TFIDF_NB},
s AS (SELECT tw.doc_id, model.class, sum(tw.n * model.log_prob) AS s
      FROM tw JOIN model ON model.term = tw.term GROUP BY tw.doc_id, model.class),
post AS (SELECT d.doc_id, pri.class, coalesce(s.s, 0.0) + pri.log_prior AS post
         FROM documents d CROSS JOIN pri LEFT JOIN s ON s.doc_id = d.doc_id AND s.class = pri.class)
SELECT doc_id, class AS pred FROM
  (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY post DESC, class) AS rn FROM post) WHERE rn = 1""")
def text_classify(spark, sf):
    """Counts -> tf-idf -> naive Bayes fit on labelled documents ->
    prediction for every document (a chained estimator)."""
    docs = _docs(spark, sf)
    dealt = _dealt_counts(spark, sf)
    idf = TX.idf_values(dealt, docs.count())
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    model, priors, classes = TX.nb_fit(TX.tfidf_lists(dealt, idf).withColumnRenamed("w", "n"), labels)
    found = TX.tfidf_lists(dealt, idf.join(model, "term", "left")).withColumnRenamed("w", "n")
    return TX.nb_predict_lists(docs, found, priors, classes).select("doc_id", "pred")


# ---------------------------------------------------------------- T11, E8
SVM_ALPHA = 1e-3


def _languages(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"))


def _svm_steps_sql(steps: int = 2) -> str:
    """Full-batch hinge steps written out: m is the margin table, w the weights
    and b the intercepts after each step."""
    a = repr(SVM_ALPHA)
    out = [f"""{_COUNTS},
lab AS MATERIALIZED (SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL AND doc_id IS NOT NULL),
nn AS (SELECT count(*) * 1.0 AS m FROM lab),
c2 AS (SELECT cnt.* FROM cnt JOIN lab ON lab.doc_id = cnt.doc_id),
d AS (SELECT term, count(*) AS df FROM c2 GROUP BY term),
u AS (SELECT c2.doc_id, c2.term, c2.n * (ln((1.0 + (SELECT m FROM nn)) / (1.0 + d.df)) + 1.0) AS w FROM c2 JOIN d ON d.term = c2.term),
x AS MATERIALIZED (SELECT u.doc_id, u.term, u.w / r.nrm AS x FROM u JOIN (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM u GROUP BY doc_id) r
                   ON r.doc_id = u.doc_id),
cl AS (SELECT DISTINCT lang AS class FROM lab),
y AS MATERIALIZED (SELECT lab.doc_id, cl.class, CASE WHEN lab.lang = cl.class THEN 1.0 ELSE -1.0 END AS y FROM lab CROSS JOIN cl),
m0 AS (SELECT doc_id, class, y, 0.0::DOUBLE AS margin FROM y),
w0 AS (SELECT DISTINCT x.term, cl.class, 0.0::DOUBLE AS w FROM x CROSS JOIN cl),
b0 AS (SELECT class, 0.0::DOUBLE AS b FROM cl)"""]
    for t in range(1, steps + 1):
        rate = f"(1.0 / ({a} * ({t} + 1.0 / {a})))"
        out.append(f"""a{t} AS MATERIALIZED (SELECT doc_id, class, y FROM m{t - 1} WHERE y * margin < 1.0),
g{t} AS (SELECT x.term, a.class, sum(-a.y * x.x) AS g FROM x JOIN a{t} a ON a.doc_id = x.doc_id GROUP BY x.term, a.class),
w{t} AS MATERIALIZED (SELECT w.term, w.class, w.w - {rate} * ({a} * w.w + coalesce(g.g, 0.0) / (SELECT m FROM nn)) AS w
  FROM w{t - 1} w LEFT JOIN g{t} g ON g.term = w.term AND g.class = w.class),
b{t} AS MATERIALIZED (SELECT b.class, b.b - {rate} * coalesce(g.g, 0.0) / (SELECT m FROM nn) AS b
  FROM b{t - 1} b LEFT JOIN (SELECT class, sum(-y) AS g FROM a{t} GROUP BY class) g ON g.class = b.class),
m{t} AS MATERIALIZED (SELECT y.doc_id, y.class, y.y, coalesce(s.s, 0.0) + b.b AS margin FROM y JOIN b{t} b ON b.class = y.class
  LEFT JOIN (SELECT x.doc_id, w.class, sum(x.x * w.w) AS s FROM x JOIN w{t} w ON w.term = x.term GROUP BY x.doc_id, w.class) s
  ON s.doc_id = y.doc_id AND s.class = y.class)""")
    return "WITH " + ",\n".join(out) + f"""
SELECT m.doc_id, lab.lang AS truth, m.class AS pred, {rs('m.margin', 7)} AS score FROM m{steps} m JOIN lab ON lab.doc_id = m.doc_id
QUALIFY row_number() OVER (PARTITION BY m.doc_id ORDER BY m.margin DESC, m.class) = 1"""


def _multi(spark, sf, iters):
    d = _docs(spark, sf)
    many = MS.prepare(TX.count_lists(d, "doc_id", "text"), _languages(spark, sf), [MS.Setting(1, 1, True, True, SVM_ALPHA)], entries=TX.n_entries(d, "text"))
    return MS.fit(many, iters)


@query("text_svm_steps", sql=_svm_steps_sql(2))
def text_svm_steps(spark, sf):
    """T11, one-vs-rest hinge over the languages: two full-batch steps of all
    classes at once on tf-idf, then every document's best class and margin."""
    return MS.predictions(_multi(spark, sf, 2)).select("doc_id", "truth", "pred", r("score", 7).alias("score"))


@query("text_svm_multi")
def text_svm_multi(spark, sf):
    """T11 / T12, one-vs-rest: counts -> tf-idf -> hinge models of all languages
    trained together (8 steps); every document's class and margin."""
    return MS.predictions(_multi(spark, sf, 8)).select("doc_id", "truth", "pred", "score")


GRID = [MS.Setting(1, high, idf, True, alpha) for high in (1, 2) for idf in (True, False) for alpha in (1e-2, 1e-3, 1e-4, 1e-5)]


@query("text_grid_search")
def text_grid_search(spark, sf):
    """E8 over the text chain: n-gram range x idf x alpha (16 settings) by 3-fold
    accuracy of hinge models of the labelled documents' kinds (junk, toxic,
    fine); all settings, folds and classes train in the same 6 passes."""
    d = _docs(spark, sf)
    counts = TX.count_lists(d, "doc_id", "text", 1, 2)
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").otherwise("fine")
    labels = table(spark, sf, "labels").select("doc_id", kind.alias("label"), EV.fold_of("doc_id", 3).alias("fold"))
    many = MS.fit(MS.prepare(counts, labels, GRID, folds=3, fold="fold", min_df=2, entries=2 * TX.n_entries(d, "text")), 6)
    return MS.grid(many).select("setting", "low", "high", "use_idf", "alpha", "n", "accuracy", "best")
