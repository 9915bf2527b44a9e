"""One query per corpus operator, over the whole table, with the production
parameters; ``SQL`` has the DuckDB form where SQL can express the operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least 10 sources share:
    doc_id, n_lines, n_removed, text."""
    from keelson.llm.lines import remove_boilerplate
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return remove_boilerplate(docs, min_sites=10).select(
        "doc_id", "n_lines", "n_removed", "text")


SQL["op7_line_spread"] = """
WITH l AS (
  SELECT doc_id, source, u.pos AS pos, u.line AS line, trim(u.line) AS t
  FROM (SELECT doc_id, source, unnest(list_zip(range(1, len(p) + 1), p)) AS z
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS p FROM documents)),
  LATERAL (SELECT z[1] AS pos, z[2] AS line) u),
bad AS (SELECT t FROM l WHERE t <> '' GROUP BY t HAVING count(DISTINCT source) >= 10),
m AS (SELECT l.*, b.t IS NOT NULL AS cut FROM l LEFT JOIN bad b USING (t))
SELECT doc_id,
  CAST(count(*) FILTER (WHERE t <> '') AS INTEGER) AS n_lines,
  CAST(count(*) FILTER (WHERE cut) AS INTEGER) AS n_removed,
  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '') AS text
FROM m GROUP BY doc_id"""


@query
def op10_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated by a seeded Poisson count so that sources meet
    weights (characters to the power 0.5), in shuffled order: the columns of
    documents, copy, shuffle_key."""
    from keelson.llm.mixing import poisson_mix
    return poisson_mix(table(spark, sf_dir, "documents"), temperature=0.5, epochs=1.0, seed=17)


SQL["op10_poisson_mix"] = """
WITH s AS (SELECT source, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS chars FROM documents GROUP BY source),
w AS (SELECT *, pow(CAST(chars AS DOUBLE), 0.5) AS w FROM s),
t AS (SELECT sum(chars) AS c, sum(w) FILTER (WHERE chars > 0) AS w FROM w),
r AS (SELECT w.source, CASE WHEN w.chars > 0 THEN w.w * t.c / t.w / w.chars ELSE 0 END AS rate FROM w, t),
k AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM r),
p AS (SELECT source, k, CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE CAST(k = 0 AS INTEGER) END AS p FROM k),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS cdf FROM p),
d AS (SELECT *, CAST(('0x' || substr(md5('17:' || doc_id), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u FROM documents)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, CAST(c.k AS INTEGER) AS "copy",
  md5('17:' || d.doc_id || ':' || c.k) AS shuffle_key
FROM d JOIN c ON c.source IS NOT DISTINCT FROM d.source AND c.cdf <= d.u"""


@query
def op5_int8_block_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of ``embeddings`` for each row whose vec_id is
    divisible by 100: query_id, rank, vec_id, score (Euclidean distance)."""
    from keelson.llm.knn import nearest
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(e.filter("vec_id % 100 = 0"), e, k=10)


SQL["op5_int8_block_knn"] = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(
    list_prepend(0.0::DOUBLE, [(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(q.v, c.v)]), lambda a, x: a + x)) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank,
  vec_id, score FROM d
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) <= 10"""


@query
def op6_rank_sync_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document under byte_bpe_50k.json: doc_id,
    n_bytes, n_tokens, over_limit (more than 512 tokens)."""
    import public_tokenizers

    from keelson.llm.tokens import token_counts
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def packed(docs: DataFrame) -> DataFrame:
    """Sequences of 2048 ids of byte_bpe_50k.tiktoken; its free id 50256 pads."""
    import public_tokenizers

    from keelson.llm.packing import pack
    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                vocab_size=50_256, seq_len=2048, pad_id=50_256)


@query
def op1_bfd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids: shard, seq, n_tokens,
    input_ids, position_ids, cu_seqlens, doc_ids, doc_starts."""
    return packed(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_spaced_seed_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of documents with benchmark items, at least 10 words of which
    80 in 100 are equal: doc_id, item_id, doc_from, doc_to, item_from, n_equal
    (word positions)."""
    from keelson.llm.decontam import overlaps
    return overlaps(table(spark, sf_dir, "documents").select("doc_id", "text"),
                    table(spark, sf_dir, "benchmark")).drop("text_key")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with p_junk, p_toxic and keep."""
    from keelson.llm.quality import classify, fit
    return classify(docs, fit(docs, labels))


@query
def op2_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps, with their scores:
    doc_id, p_junk, p_toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classified(docs, table(spark, sf_dir, "labels")).filter("keep").select("doc_id", "p_junk", "p_toxic")


@query
def op9_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents (five-word shingles, Jaccard at
    least 0.8): doc_id, class_id, set_id, n_links, n_copies."""
    from keelson.llm.setjoin import similarity_classes
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similarity_classes(docs, similarity=0.8, k=5).drop("text_key")


@query
def op4_sparse_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of at least 50 words that another document
    holds as well: doc_id, n_words, n_repeated, spans (word positions)."""
    from keelson.llm.repeats import repeated_passages
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeated_passages(docs, min_words=50).drop("text_key")


@query
def op3_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans."""
    from keelson.llm.pii import pii_spans
    return pii_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op12_fingerprint_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of 2 to 5 words found at least
    100 times: lang, rank, phrase, a, l, r, n, score."""
    from keelson.llm.collocations import collocations
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return collocations(docs, min_count=100, top=2000, covered=100).drop("example")


SQL["op12_fingerprint_collocations"] = """
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
  FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(ws) >= m),
f AS MATERIALIZED (SELECT lang, phrase, m, count(*) AS a, string_split(phrase, ' ') AS ws FROM g GROUP BY lang, phrase, m HAVING count(*) >= 100),
k AS (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1),
s AS (SELECT k.lang, k.phrase, k.a, k.k, l.a AS l, r.a AS r, t.n,
    CAST((1000::HUGEINT * k.a * t.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM k JOIN t ON t.lang = k.lang
  JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k.k], ' ')
  JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, array_to_string(ws[u.i:u.i + u.j - 1], ' ') AS phrase, max(a) AS longer
  FROM f, (SELECT i, j FROM range(1, 5) x(i), range(2, 5) y(j)) u
  WHERE m > 2 AND u.j < m AND u.i + u.j - 1 <= m GROUP BY ALL),
c AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score FROM c
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""


@query
def op11_pivot_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector of ``embeddings`` as 8 codebook entries: vec_id,
    code, error, label_error, codebooks_sha256."""
    from keelson.llm.codebooks import compressed
    return compressed(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def _codebook_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds written out: b holds codebooks, a the nearest entries."""
    squares = "CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x.xs, b.xs)]) AS BIGINT)"
    ctes = [f"""v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label,
    [CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0)""",
            f"""x AS MATERIALIZED (SELECT rid, p, x[p * len(x) // {parts} + 1:(p + 1) * len(x) // {parts}] AS xs
  FROM v, (SELECT unnest(range({parts})) AS p))""",
            f"b0 AS MATERIALIZED (SELECT p, rid - 1 AS e, xs FROM x WHERE rid <= {entries})"]
    for i in range(rounds + 1):
        ctes.append(f"a{i} AS MATERIALIZED (SELECT x.rid, x.p, min({squares} * {entries} + b.e) AS m "
                    f"FROM x JOIN b{i} b ON b.p = x.p GROUP BY x.rid, x.p)")
        if i < rounds:
            ctes.append(f"""b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.xs, b.xs) AS xs FROM b{i} b LEFT JOIN (
    SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY i) AS xs FROM (
      SELECT a.p, a.m % {entries} AS e, u.i, CAST(sum(x.xs[u.i]) AS BIGINT) AS s, count(*) AS c
      FROM a{i} a JOIN x ON x.rid = a.rid AND x.p = a.p, LATERAL (SELECT unnest(range(1, len(x.xs) + 1)) AS i) u
      GROUP BY ALL) GROUP BY p, e) n ON n.p = b.p AND n.e = b.e)""")
    return f"""WITH {", ".join(ctes)},
r AS (SELECT rid, string_agg(printf('%02x', m % {entries}), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY rid),
h AS (SELECT sha256(string_agg(array_to_string(xs, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT v.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, h.codebooks_sha256
FROM v JOIN r USING (rid), h"""


SQL["op11_pivot_codebooks"] = _codebook_sql()


@query
def op13_charconv_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_likely (findings the network holds likely)."""
    from keelson.llm.secret_scan import KINDS, secret_findings
    found = secret_findings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("findings", lambda f: f["base"])
    joined = lambda a: F.array_join(F.transform(a, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
    kinds = F.transform(base, lambda f: f["kind"])
    return found.select(
        "doc_id", *[F.size(F.filter(kinds, F.lit(k).__eq__)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"),
        F.size(F.filter("findings", lambda f: f["likely"])).cast("long").alias("n_likely"))
