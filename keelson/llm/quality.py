"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document, for two aspects: junk
(symbols, capitals, repeats ...) and toxicity (a seed word list, words typical
of labelled toxic documents, the given labels).  Expectation-maximisation over
the counts of vote patterns of all documents estimates each labeller's
accuracy; the posterior labels of a bounded sample train one hashed linear
scorer per aspect, which then scores every document.
"""

from __future__ import annotations

import functools
import math
import operator
from collections import Counter
from collections.abc import Iterator, Set
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import free_name, normal, small_batches, BROADCAST_IDS, Recent

# The bounded sample that the scorers are fitted on.
SAMPLE_DOCS = 10_000       # documents, labelled ones first, in order of a hash
SAMPLE_CHARS = 20_000      # longer documents are not drawn into the sample
BUCKETS = 1 << 17          # hashed features of each scorer
LEXICON_ODDS = 4.0         # log odds of a word that is typical of toxic documents
LEXICON_DOCS = 4           # and the least toxic documents that hold it
JUNK_L1, TOXIC_L1 = 1e-5, 2e-3   # penalties of the scorers

# Insults that seed the toxicity labeller, and frequent function
# words of the corpus' languages.
INSULTS = frozenset("stupid idiot moron loser scum trash pathetic worthless disgusting clown".split())
FUNCTION_WORDS = frozenset(
    "the of and to in is it that was for on are as with be by this at or from a "
    "le la les de des et un une que pas est dans pour qui der die das und ist im "
    "den von zu mit nicht ein eine el los las y en del se por con no su al lo".split())

# Labellers, and for each aspect its latent classes: the fine one and one per
# failure mode, with the labellers that should see it.
JUNK = ("symbols", "capitals", "repeats", "bare_symbols", "marked_words", "function_words", "variety", "top_word",
        "given_junk")
JUNK_MODES = (("symbols", "capitals", "marked_words", "given_junk"), ("repeats", "variety", "top_word", "given_junk"),
              ("bare_symbols", "symbols", "function_words", "given_junk"))
TOXIC = ("insults", "lexicon", "given_toxic")
TOXIC_MODES = (("insults", "lexicon", "given_toxic"), ("lexicon", "given_toxic"))


# ---- statistics of a text ----------------------------------------------------
SIGN, LOWER, CAPITAL, DIGIT, BLANK, CLOSING, CLASSES = range(7)
CLOSING_SIGNS = ".,;:!?"
NAMED = np.isin(np.arange(CLASSES), (LOWER, CAPITAL, DIGIT))
MARKED = np.isin(np.arange(0x100), np.frombuffer(b"!#$%&*=~^|", np.uint8))


@functools.lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every character up to U+FFFE; later ones count as signs."""
    out = np.zeros(0x10000, np.uint8)
    for i in range(0xFFFF):
        c = chr(i)
        out[i] = (BLANK if c.isspace() else CAPITAL if c.isupper() else LOWER if c.isalpha() else DIGIT if c.isdigit()
                  else CLOSING if c in CLOSING_SIGNS else SIGN)
    return out


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return class_table()[np.minimum(codes, 0xFFFF)]


def plain_words(text: str) -> list[str]:
    """Words in lower case, cut at blanks and closing signs."""
    low = text.lower()
    for c in CLOSING_SIGNS:
        low = low.replace(c, " ")
    return low.split()


def mark_runs(text: str) -> int:
    """Runs of at least two marks (all marks are ASCII)."""
    m = MARKED[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    return int(np.count_nonzero(m[1:] & m[:-1] & ~np.append(False, m[:-2])))


def statistics(text: str) -> tuple[np.ndarray, Set[str], dict[str, float]]:
    """(character classes, distinct words, ratios that labellers and scorers
    use) of a text."""
    cls, words = classes_of(text), plain_words(text)
    count = np.bincount(cls, minlength=CLASSES).tolist()
    blank = cls == BLANK
    starts = np.flatnonzero(np.diff(blank, prepend=True) & ~blank) if len(cls) else cls
    bare = len(starts) - int(np.count_nonzero(np.logical_or.reduceat(NAMED[cls], starts))) if len(starts) else 0
    n, letters, signs = max(1, len(words)), count[LOWER] + count[CAPITAL], count[SIGN] + count[CLOSING]
    held = Counter(words)
    return cls, held.keys(), {
        "words": len(words), "symbols": signs / max(1, signs + letters), "capitals": count[CAPITAL] / max(1, letters),
        "repeats": sum(map(operator.eq, words, words[1:])) / n,
        "bare": bare / max(1, len(starts)),
        "marked": mark_runs(text) / n, "function": sum(map(held.__getitem__, FUNCTION_WORDS.intersection(held))) / n,
        "variety": len(held) / n, "top": max(held.values(), default=0) / n,
        "insults": len(INSULTS.intersection(held))}


def bucket(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) % BUCKETS


@functools.lru_cache(maxsize=50_000)
def beginning(name: str) -> int:
    return bucket(name)


def toxic_features(word: str) -> tuple[int, ...]:
    """Buckets of a word and of its beginnings (words of rich inflection)."""
    w = normal(word)
    return (bucket("w" + w), beginning("4" + w[:4]), beginning("5" + w[:5])) if len(w) > 2 else ()


def junk_votes(s: dict[str, float]) -> tuple[int, ...]:
    """1: junk, 0: fine, -1: no opinion, for each labeller of JUNK but the given labels."""
    def vote(x, junk, fine, sure=True):
        return -1 if not sure else 1 if junk(x) else 0 if fine(x) else -1
    return (vote(s["symbols"], lambda x: x > 0.15, lambda x: x < 0.08),
            vote(s["capitals"], lambda x: x > 0.5, lambda x: x < 0.25),
            vote(s["repeats"], lambda x: x > 0.2, lambda x: x < 0.05, s["words"] >= 2),
            vote(s["bare"], lambda x: x > 0.2, lambda x: x < 0.05),
            vote(s["marked"], lambda x: x > 0.2, lambda x: x < 0.03),
            vote(s["function"], lambda x: x < 0.02, lambda x: x > 0.1, s["words"] >= 20),
            vote(s["variety"], lambda x: x < 0.12, lambda x: x > 0.25, s["words"] >= 50),
            vote(s["top"], lambda x: x > 0.25, lambda x: x < 0.15, s["words"] >= 20))


# ---- expectation-maximisation over vote patterns ---------------------------
@dataclass
class LabelModel:
    """Latent classes: 0 is fine, the others are failure modes."""

    prior: np.ndarray          # share of each class
    fires: np.ndarray          # P(vote 1 | class) of each labeller that votes

    def classes(self, votes: np.ndarray) -> np.ndarray:
        """P(class) of each row of votes; abstentions say nothing."""
        log = np.tile(np.log(self.prior), (len(votes), 1))
        for j in range(votes.shape[1]):
            f = self.fires[j]
            log += np.where(votes[:, j:j + 1] == 1, np.log(f), np.where(votes[:, j:j + 1] == 0, np.log(1 - f), 0.0))
        p = np.exp(log - log.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(any failure mode) of each row of votes."""
        return 1 - self.classes(votes)[:, 0]

    def accuracies(self) -> np.ndarray:
        """P(vote is right | labeller votes), failure modes taken together."""
        bad = self.prior[1:] / self.prior[1:].sum()
        return (self.prior[0] * (1 - self.fires[:, 0])
                + (1 - self.prior[0]) * (self.fires[:, 1:] @ bad))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, names: tuple[str, ...],
                    modes: tuple[tuple[str, ...], ...], rounds: int = 60, sees: float = 0.85,
                    misses: float = 0.1, weight: float = 0.005, share: float = 0.03) -> LabelModel:
    """EM over vote patterns and their counts.  It starts with labellers that
    fire with probability ``sees`` on the modes they are for and ``misses``
    elsewhere; pseudo-votes of that kind, ``weight`` times the number of
    documents, keep a mode's meaning where hardly any document shows it."""
    k = len(modes) + 1
    start = np.array([[0.02, *(sees if n in m else misses for m in modes)] for n in names])
    total = max(1.0, float(counts.sum()))
    pseudo = weight * total
    model = LabelModel(np.array([1 - share * (k - 1), *[share] * (k - 1)]), start)
    for _ in range(rounds):
        mass = model.classes(votes) * counts[:, None]
        fires = np.empty_like(start)
        for j in range(len(names)):
            cast, ones = mass[votes[:, j] >= 0].sum(axis=0), mass[votes[:, j] == 1].sum(axis=0)
            fires[j] = (ones + start[j] * pseudo) / (cast + pseudo)
        prior = (mass.sum(axis=0) + 1e-3 * total) / (total * (1 + 1e-3 * k))
        fires = np.clip(fires, 1e-3, 1 - 1e-3)
        done = np.abs(prior - model.prior).max() + np.abs(fires - model.fires).max() < 1e-7
        model = LabelModel(prior, fires)
        if done:
            break
    return model


# ---- hashed linear scorers -------------------------------------------------
def fit_linear(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray,
               size: int, l1: float, rounds: int = 200, rate: float = 0.5) -> np.ndarray:
    """Logistic weights (last: bias) by full-batch proximal Adagrad on soft
    targets with an L1 penalty; the classes weigh the same in total.  (doc,
    feature, value) are the non-zeros.  Features whose gradient at zero is far
    below the penalty are left out at once."""
    n, pos = max(1, len(target)), float(target.sum())
    weight = target * (0.5 / max(pos, 1)) + (1 - target) * (0.5 / max(n - pos, 1))
    first = np.bincount(feature, ((0.5 - target) * weight)[doc] * value, size)
    kept = np.flatnonzero(np.abs(first) >= 0.7 * l1)
    number = np.full(size, -1)
    number[kept] = np.arange(len(kept))
    use = number[feature] >= 0
    doc, feature, value = doc[use], number[feature[use]], value[use]
    w, grad2 = np.zeros(len(kept) + 1), np.full(len(kept) + 1, 1e-10)
    for _ in range(rounds):
        z = np.bincount(doc, w[feature] * value, n) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight
        g = np.append(np.bincount(feature, err[doc] * value, len(kept)), err.sum())
        grad2 += g * g
        w -= rate * g / np.sqrt(grad2)
        w[:-1] = np.sign(w[:-1]) * np.maximum(0, np.abs(w[:-1]) - rate * l1 / np.sqrt(grad2[:-1]))
    out = np.zeros(size + 1)
    out[kept], out[-1] = w[:-1], w[-1]
    return out


RATIOS = ("symbols", "capitals", "repeats", "bare", "marked", "top")


@functools.lru_cache(maxsize=1)
def junk_buckets() -> np.ndarray:
    """Buckets of the runs of three character classes, then of the ratios."""
    return np.array([bucket(f"c{i}") for i in range(CLASSES ** 3)] + [bucket("r" + r) for r in RATIOS])


def junk_values(cls: np.ndarray, ratios: dict[str, float]) -> np.ndarray:
    """Shares of the runs of three character classes, then the ratios, in the
    order of :func:`junk_buckets`."""
    c = cls.astype(np.int16)
    runs = np.bincount(c[:-2] * CLASSES ** 2 + c[1:-1] * CLASSES + c[2:], minlength=CLASSES ** 3)
    return np.concatenate([runs / max(1, len(c) - 2), [ratios[r] for r in RATIOS]])


def toxic_row(features: Recent, distinct: Set[str]) -> np.ndarray:
    """The buckets that a text's words hold."""
    return np.unique(np.array([x for w in distinct for x in features[w]], np.int64))


@dataclass
class Classifier:
    junk_model: LabelModel
    toxic_model: LabelModel
    lexicon: np.ndarray        # buckets of words typical of toxic documents
    junk_w: np.ndarray
    toxic_w: np.ndarray

    def scorer(self):
        tw, jw = self.toxic_w, self.junk_w[junk_buckets()]
        held = Recent(lambda raw: tuple(x for x in toxic_features(raw) if tw[x]))
        share = lambda z: 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        def score(text: str) -> tuple[float, float]:
            cls, distinct, ratios = statistics(text)
            toxic = tw[-1] + math.fsum(tw[x] for x in set().union(*map(held.__getitem__, distinct)))
            return share(float(self.junk_w[-1] + junk_values(cls, ratios) @ jw)), share(float(toxic))
        return score


def toxic_votes(insults: np.ndarray, hits: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Votes of the labellers of TOXIC: any insult; at least two buckets of the
    lexicon, no opinion at one; the given label."""
    return np.stack([insults > 0, np.where(hits >= 2, 1, np.where(hits == 0, 0, -1)), given], axis=1).astype(int).reshape(-1, 3)


def word_counts(d: DataFrame, given: DataFrame) -> DataFrame:
    """(bucket, n_toxic, n_fine): the labelled documents that hold each bucket;
    all documents of a label under bucket -1.  Up to BROADCAST_IDS labels meet
    the texts by broadcast; beyond, both are shuffled by id."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, held = Recent(toxic_features), np.zeros((2, BUCKETS + 1), np.int64)
        for b in batches:
            for t, toxic in zip(b["text"], b["toxic"]):
                n = held[int(toxic == 1)]
                n[toxic_row(words, set(plain_words(t)))] += 1
                n[-1] += 1
        on = np.flatnonzero(held.any(axis=0))
        yield pd.DataFrame({"bucket": np.where(on == BUCKETS, -1, on), "n_toxic": held[1, on], "n_fine": held[0, on]})

    said = given.filter("toxic >= 0").select("_id", "toxic")
    said = F.broadcast(said) if said.count() <= BROADCAST_IDS else said
    return (d.join(said, d["doc_id"] == said["_id"]).filter("length(text) > 0")
            .select("text", "toxic").mapInPandas(run, "bucket long, n_toxic long, n_fine long")
            .groupBy("bucket").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_fine").alias("n_fine")))


def learn_lexicon(counts: pd.DataFrame) -> np.ndarray:
    """Buckets far more frequent in documents labelled toxic than in others,
    from :func:`word_counts`."""
    held = np.zeros((2, BUCKETS + 1), np.int64)
    held[:, counts["bucket"].to_numpy(np.int64)] = counts[["n_toxic", "n_fine"]].to_numpy(np.int64).T
    (d1, d0), (n1, n0) = held[:, :-1], np.maximum(1, held[:, -1])
    odds = np.log((d1 + 0.5) / (n1 + 1)) - np.log((d0 + 0.5) / (n0 + 1))
    return np.flatnonzero((odds > LEXICON_ODDS) & (d1 >= LEXICON_DOCS))


def with_labels(docs: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text, junk, toxic): one label row per id (the greatest values);
    null where there is none."""
    given = (labels.select(F.col("doc_id").alias("_id"), (1 - F.col("quality")).alias("junk"), "toxic")
             .filter("_id IS NOT NULL").groupBy("_id").agg(F.max("junk").alias("junk"), F.max("toxic").alias("toxic")))
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")), given


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Classifier:
    """Fit the lexicon on all labelled documents, the label models on the vote
    patterns of all documents and the scorers on a bounded sample (SAMPLE_DOCS documents of at most SAMPLE_CHARS
    characters).  An empty table gives a classifier that keeps everything
    without a vote against it."""
    small_batches(docs.sparkSession)
    d, given = with_labels(docs, labels, key, text)
    # the labels of ids, without the texts: the sample's ids are bounded
    ids = docs.select(F.col(key).alias("doc_id"), F.length(text).alias("n")).filter(f"n > 0 AND n <= {SAMPLE_CHARS}")
    drawn = (ids.join(given, ids["doc_id"] == given["_id"], "left")
             .select("doc_id", "junk", "toxic")
             .orderBy(F.col("toxic").isNull(), F.xxhash64("doc_id", F.lit(11))).limit(SAMPLE_DOCS))
    sample = d.join(F.broadcast(drawn), "doc_id").filter(f"length(text) <= {SAMPLE_CHARS}")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Recent(toxic_features)
        for b in batches:
            rows = []
            for t, junk, toxic in zip(b["text"], b["junk"], b["toxic"]):
                cls, distinct, s = statistics(t)
                v = junk_values(cls, s)
                on = np.flatnonzero(v)
                rows.append((*junk_votes(s), -1 if pd.isna(junk) else int(junk), int(s["insults"]),
                             -1 if pd.isna(toxic) else int(toxic), junk_buckets()[on].astype(np.int32).tobytes(),
                             v[on].astype(np.float32).tobytes(), toxic_row(words, distinct).astype(np.int32).tobytes()))
            yield pd.DataFrame(rows, columns=[*JUNK, "n_insults", "given", "jb", "jv", "tb"])

    votes_schema = ", ".join(f"{c} int" for c in (*JUNK, "n_insults"))
    drawn_rows = sample.orderBy("doc_id").mapInPandas(
        features, votes_schema + ", given int, jb binary, jv binary, tb binary").toPandas()
    arrays = lambda c, kind: [np.frombuffer(x, kind) for x in drawn_rows[c]]
    toxic_rows = arrays("tb", np.int32)
    labels_of = drawn_rows["given"].to_numpy(int)
    lexicon = learn_lexicon(word_counts(d, given).toPandas())   # at most BUCKETS + 1 rows

    # votes of all documents, as counts of patterns
    typical = frozenset(lexicon.tolist())

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = Recent(lambda raw: tuple(typical.intersection(toxic_features(raw))))
        for b in batches:
            rows = []
            for i, t in zip(b["doc_id"], b["text"]):
                _, distinct, s = statistics(t)
                rows.append((i, *junk_votes(s), min(1, int(s["insults"])),
                             min(2, len(set().union(*map(held.__getitem__, distinct))))))
            yield pd.DataFrame(rows, columns=["doc_id", *JUNK[:-1], "n_insults", "n_lexicon"])

    kind = docs.schema[key].dataType.simpleString()
    votes = d.mapInPandas(vote, f"doc_id {kind}, " + ", ".join(f"{c} int" for c in (*JUNK[:-1], "n_insults", "n_lexicon")))
    votes = (votes.join(given, votes["doc_id"] == given["_id"], "left")
             .withColumn(JUNK[-1], F.coalesce(F.col("junk").cast("int"), F.lit(-1)))
             .withColumn("given", F.coalesce(F.col("toxic").cast("int"), F.lit(-1))))
    patterns = votes.groupBy(*JUNK, "n_insults", "n_lexicon", "given").count().toPandas()
    counts = patterns["count"].to_numpy(float)
    junk_model = fit_label_model(patterns[list(JUNK)].to_numpy(int).reshape(-1, len(JUNK)), counts, JUNK, JUNK_MODES)
    toxic_model = fit_label_model(toxic_votes(*(patterns[c].to_numpy(int) for c in ("n_insults", "n_lexicon", "given"))),
                                  counts, TOXIC, TOXIC_MODES)

    # posterior labels of the sample train the scorers
    in_lexicon = np.zeros(BUCKETS, bool)
    in_lexicon[lexicon] = True
    hits = np.array([in_lexicon[b].sum() for b in toxic_rows], int)
    junk_p = junk_model.posterior(drawn_rows[list(JUNK)].to_numpy(int).reshape(-1, len(JUNK)))
    toxic_p = toxic_model.posterior(toxic_votes(drawn_rows["n_insults"].to_numpy(int), hits, labels_of))

    def scorer(rows: list[np.ndarray], values: list[np.ndarray] | None, target: np.ndarray, l1: float) -> np.ndarray:
        if not len(rows):
            return np.append(np.zeros(BUCKETS), -1.0)
        doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(b) for b in rows])
        value = np.ones(len(doc), np.float32) if values is None else np.concatenate(values)
        return fit_linear(doc, np.concatenate(rows), value, target, BUCKETS, l1)

    return Classifier(junk_model, toxic_model, lexicon,
                      scorer(arrays("jb", np.int32), arrays("jv", np.float32), junk_p, JUNK_L1),
                      scorer(toxic_rows, None, toxic_p, TOXIC_L1))


def classify(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text",
             threshold: float = 0.6, prefix: str = "") -> DataFrame:
    """``docs`` with p_junk, p_toxic and keep (both at most ``threshold``), their
    names led by ``prefix``.

    A null or empty text has nothing against it: both scores 0, kept.  Columns
    with these names are replaced, all others stay; repeated rows score alike.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of BUCKETS weights
    names, keep = [prefix + "p_junk", prefix + "p_toxic"], prefix + "keep"

    @F.pandas_udf("p_junk double, p_toxic double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = shared.value.scorer()
        for b in texts:
            yield pd.DataFrame([score(t) if t and not t.isspace() else (0.0, 0.0) for t in b], columns=["p_junk", "p_toxic"])

    # said to be nondeterministic, so that a filter on the scores doesn't run it twice
    once = scores.asNondeterministic()
    both = free_name(docs, "_scores")
    return (docs.drop(*names, keep).withColumn(both, once(F.col(text).cast("string")))
            .withColumns({names[0]: F.col(f"{both}.p_junk"), names[1]: F.col(f"{both}.p_toxic")}).drop(both)
            .withColumn(keep, (F.col(names[0]) <= threshold) & (F.col(names[1]) <= threshold)))
