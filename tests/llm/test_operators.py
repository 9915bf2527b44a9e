"""Each corpus operator against a brute-force version, an exact round trip or
held-out accuracy, and on awkward tables: nulls, empty and very long texts,
ties, repeated rows, no rows, extra columns with clashing names."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import decontam, knn, lines, mixing, packing, pii, quality, repeats, setjoin, tokens
from keelson.llm.common import connected_components, normal, words_of

public_tokenizers = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = ["".join(random.Random(i).choices("abcdefghilmnoprstu", k=2 + i % 7)) for i in range(400)]


def prose(seed, n):
    return " ".join(random.Random(seed).choices(VOCAB, k=n))


def docs_of(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or {}).get(i, f"s{(i or 0) % 3}"), 0) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


AWKWARD = [(1, prose(1, 80)), (1, prose(1, 80)), (2, prose(1, 80)), (3, None), (4, ""), (5, "?! ... --"),
           (None, prose(9, 30)), (6, prose(6, 9000)), (7, "a b c\tnáive \U0001f600 你好"), (8, "x" * 50_000),
           (9, prose(6, 9000).replace(VOCAB[3], VOCAB[5], 3)), (10, "one two")]


def awkward(spark):
    """Rows with nulls in any column, repeats, odd texts and clashing names."""
    d = docs_of(spark, AWKWARD, {2: None})
    for name in ("copy", "shuffle_key", "keep", "p_junk", "text_key", "node", "words", "n_lines", "n", "component", "_s", "_key",
                 "_cut", "_kept", "_scores"):
        d = d.withColumn(name, F.lit("own"))
    return d


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- 1 packing ---------------------------------------------------------------
def pack(df, seq_len=64):
    return packing.pack(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50_256,
                        seq_len=seq_len, pad_id=50_256)


def test_best_fit_decreasing_is_best_fit():
    rng = np.random.default_rng(1)
    for cap in (1, 5, 8, 100):
        sizes = rng.integers(1, cap + 1, 300)
        bins = packing.best_fit_decreasing(sizes, cap)
        room = []
        for n in sorted(sizes.tolist(), reverse=True):
            fit = [r for r in room if r >= n]
            if fit:
                room.remove(min(fit))
            room.append((min(fit) if fit else cap) - n)
        assert sorted(cap - sizes[b].sum() for b in bins) == sorted(room)
        assert sorted(i for b in bins for i in b) == list(range(300))
    assert packing.best_fit_decreasing(np.array([], int), 4) == []


def test_packing_gives_every_id_back(spark):
    import base64

    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    packed = pack(awkward(spark)).persist()
    got = collections.defaultdict(list)
    for r in packing.segments(packed, 64).collect():
        got[r["doc_id"]].append((r["start"], tuple(r["ids"])))
    want = collections.Counter((i, tuple(enc.encode_ordinary(t))) for i, t in AWKWARD if t)
    assert set(got) == {i for i, _ in want}
    for (i, ids), times in want.items():
        pieces = collections.Counter((p, ids[p:p + 64]) for p in range(0, len(ids), 64))
        assert collections.Counter(got[i]) == collections.Counter({k: v * times for k, v in pieces.items()})
    for r in packed.collect():
        ids, pos, cu = np.frombuffer(r["input_ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2"), r["cu_seqlens"]
        assert len(ids) == len(pos) == 64 and cu[0] == 0 and cu[-1] == r["n_tokens"] and len(cu) == len(r["doc_ids"]) + 1
        assert (ids[cu[-1]:] == 50_256).all()
        want_pos = np.concatenate([np.arange(b - a) for a, b in zip(cu, [*cu[1:], 64])][:len(cu)])
        assert (pos == want_pos).all()
    assert pack(empty(spark)).count() == 0


def test_copies_of_a_row_spread_over_the_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_CHARS", 20_000)
    packed = pack(docs_of(spark, [(5, prose(5, 40))] * 1500).repartition(4))
    held = collections.Counter()
    for r in packed.collect():
        held[r["shard"]] += len(r["doc_ids"])
    assert sum(held.values()) == 1500 * -(-sum(held.values()) // 1500) and len(held) >= 12
    assert max(held.values()) < 1.6 * sum(held.values()) / len(held)


def test_users_columns_stay(spark):
    d = awkward(spark)
    own = {"_s", "_key", "_cut", "_kept", "_scores"}
    out = lines.remove_boilerplate(d, min_sites=2)
    assert own <= set(out.columns) and out.filter(" OR ".join(f"{c} <> 'own'" for c in own)).count() == 0
    assert out.count() == len(AWKWARD)


def test_matrices_are_written(spark, scratch):
    packed = pack(docs_of(spark, [(i, prose(i, 40)) for i in range(12)]))
    packing.write_matrices(packed, f"{scratch}/m", rows=4)
    back = spark.read.parquet(f"{scratch}/m").collect()
    rows = {(r["shard"], r["seq"]): r for r in packed.collect()}
    assert sum(b["n_rows"] for b in back) == len(rows)
    for b in back:
        ids = np.frombuffer(b["ids"], "<u2").reshape(b["n_rows"], 64)
        cu, at = np.frombuffer(b["cu_seqlens"], "<i4"), np.frombuffer(b["row_offsets"], "<i4")
        for i in range(b["n_rows"]):
            r = rows[(b["shard"], b["block"] * 4 + i)]
            assert ids[i].tobytes() == r["input_ids"] and cu[at[i]:at[i + 1]].tolist() == r["cu_seqlens"]


# ---- 2 quality ---------------------------------------------------------------
def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(20_000) < 0.2
    acc = {"a": 0.95, "b": 0.8, "c": 0.7}
    votes = np.stack([np.where(rng.random(len(y)) < a, y, ~y) for a in acc.values()], axis=1).astype(int)
    votes[rng.random(len(y)) < 0.3, 2] = -1
    pat, n = np.unique(votes, axis=0, return_counts=True)
    m = quality.fit_label_model(pat, n.astype(float), tuple(acc), (tuple(acc),))
    assert m.accuracies() == pytest.approx(list(acc.values()), abs=0.03)
    assert m.prior[1] == pytest.approx(0.2, abs=0.03)
    assert m.posterior(np.full((1, 3), -1)) == pytest.approx(m.prior[1:].sum())


def corpus(spark, n, seed):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        text, kind = prose(seed * 100_000 + i, rng.randint(30, 120)), rng.random()
        words = text.split()
        if kind < 0.15:
            text = rng.choice([" ".join(w.upper() + "!!" for w in words), " | ".join(words), " ".join([words[0]] * len(words))])
        elif kind < 0.3:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zorkel", "grubnak", "idiot"]))
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(kind >= 0.15), int(0.15 <= kind < 0.3)))
    return docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_documents(spark):
    docs, labels = corpus(spark, 900, 1)
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    fresh, truth = corpus(spark, 500, 2)
    r = quality.classify(fresh, model).join(truth, "doc_id").selectExpr(
        "keep", "quality = 1 AND toxic = 0 AS fine").toPandas()
    assert r[r["fine"]]["keep"].mean() > 0.97 and (~r[~r["fine"]]["keep"]).mean() > 0.95


def test_classifier_on_awkward_rows(spark):
    d = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, None), (None, 0, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    out = quality.classify(d, quality.fit(d, labels), prefix="_q_")
    assert out.count() == len(AWKWARD) and set(d.columns) < set(out.columns)
    kept = {(r["doc_id"], r["text"]) for r in out.filter("_q_keep").collect()}
    assert {(3, None), (4, "")} <= kept
    none = quality.fit(empty(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert quality.classify(empty(spark), none).count() == 0
    assert quality.classify(docs_of(spark, [(1, prose(1, 50))]), none).first()["keep"]


def test_share_of_the_most_frequent_word():
    rng = random.Random(33)
    for trial in range(200):
        words = [f"w{i}" for i in range(rng.randint(1, 70))] + ["often"] * rng.randint(0, 30)
        rng.shuffle(words)
        top = max(map(words.count, words)) / len(words)
        assert quality.statistics(" ".join(words))[2]["top"] == top
    words = [f"w{i}" for i in range(40)]
    for i in (*range(1, 9), *range(11, 16)):      # not at the quarters
        words[i] = "often"
    s = quality.statistics(" ".join(words))[2]
    assert s["top"] == 13 / 40 and quality.junk_votes(s)[quality.JUNK.index("top_word")] == 1
    assert quality.statistics("")[2]["top"] == 0


def test_lexicon_covers_all_labelled_documents(spark, monkeypatch):
    docs, labels = corpus(spark, 300, 3)
    toxic = {r["doc_id"]: r["toxic"] for r in labels.filter("doc_id % 3 > 0").collect()}
    # some long ones, and a word that only they and a few others hold
    rare = [i for i, t in toxic.items() if t][::4]
    docs = docs.withColumn("text", F.when(F.col("doc_id").isin(rare), F.concat("text", F.lit(" quibnor"), F.repeat(
        F.lit(" x"), F.when(F.col("doc_id").isin(rare[::2]), 15_000).otherwise(1)))).otherwise(F.col("text")))
    held, n = collections.Counter(), collections.Counter(toxic.values())
    for r in docs.collect():
        if r["doc_id"] in toxic:
            buckets = {x for w in quality.plain_words(r["text"]) for x in quality.toxic_features(w)}
            held.update((x, toxic[r["doc_id"]]) for x in buckets)
    odds = lambda x: math.log((held[x, 1] + 0.5) / (n[1] + 1)) - math.log((held[x, 0] + 0.5) / (n[0] + 1))
    want = sorted(x for x in {x for x, _ in held} if held[x, 1] >= 4 and odds(x) > 4)
    monkeypatch.setattr(quality, "SAMPLE_DOCS", 40)
    got = quality.fit(docs, labels.filter("doc_id % 3 > 0")).lexicon.tolist()
    assert got == want and quality.toxic_features("zorkel")[0] in want


# ---- 3 personal data -----------------------------------------------------------
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(t):
    fits = [lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")),
            lambda s: 13 <= len(pii.digits(s)) <= 19 and pii.luhn(pii.digits(s)), lambda s: 9 <= len(pii.digits(s)) <= 15]
    return [(k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, t) if fits[k](m[0])]


def test_base_spans_equal_the_patterns():
    rng = random.Random(4)
    for _ in range(20_000):
        t = "".join(rng.choice("0123456789@.+- ()aB_%é٣\n,0123456789.- ") for _ in range(rng.randint(0, 50)))
        assert pii.base_spans(t) == brute_spans(t), t
    assert pii.luhn("4532015112830366") and not pii.luhn("4532015112830367")
    assert pii.base_spans("9" * 6000 + ".1.1.1") == []


def test_field_on_held_out_lines():
    field = pii.trained()
    table = pii.labelled_table(3, seed=321)
    got = pii.field_spans(field, [t for t, _ in table])
    assert sum(g == s for g, (_, s) in zip(got, table)) / len(table) > 0.95


def test_field_path_is_the_best_path():
    field = pii.trained()
    text = "tel 555-0100 a (at) b"
    pieces = next(pii.stretches(text))
    scores = field.scores(pii.feature_names(text, pieces), [p[2] for p in pieces])[:4]
    move = np.where(pii.Field.legal(), field.move, -1e9)
    best, n = None, len(pii.LABELS)
    for path in np.ndindex(*[n] * len(scores)):
        s = sum(scores[i][p] for i, p in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
        s += -1e9 * (pii.LABELS[path[0]][0] == "I")
        if best is None or s > best[0]:
            best = (s, path)
    assert field.decode([scores])[0].tolist() == list(best[1])


def test_pii_on_awkward_rows(spark):
    extra = [(20, "mail jo@x.org, +1 (386) 555-3733 or 386-555-3733; 10.0.0.1; 4532 0151 1283 0366 joe (at) site (dot) org")]
    d = awkward(spark).unionByName(docs_of(spark, extra), allowMissingColumns=True)
    rows = pii.pii_spans(d).collect()
    assert len(rows) == len(AWKWARD) + 1
    r = next(x for x in rows if x["doc_id"] == 20)
    base = brute_spans(extra[0][1])
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    assert r["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
    spans = [s.split(":") for s in r["spans"].split(",")]
    found = {(k, extra[0][1][int(a):int(b)]) for k, a, b in spans}
    assert {("phone", "386-555-3733"), ("email", "joe (at) site (dot) org"), ("email", "jo@x.org")} <= found
    clean = next(x for x in rows if x["doc_id"] == 4)
    assert clean["spans"] == "" and clean["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.pii_spans(empty(spark)).count() == 0


def test_a_long_stretch_is_decoded_alone():
    """A line of many numbers among short texts costs its own cells only."""
    import tracemalloc
    field = pii.trained()
    rng = np.random.default_rng(4)
    short = [rng.normal(size=(int(n), len(pii.LABELS))) for n in rng.integers(1, 12, 400)]
    long = rng.normal(size=(100_000, len(pii.LABELS)))
    alone = field.decode([long])[0]
    tracemalloc.start()
    together = field.decode([*short[:200], long, *short[200:]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (together[200] == alone).all()
    assert all((a == b).all() for x, b in zip(short, [*together[:200], *together[201:]]) for a in field.decode([x]))
    assert peak < 60e6


# ---- 4 repeated passages ---------------------------------------------------------
def brute_repeats(texts, n):
    words = [words_of(t) for _, t in texts]
    held = collections.defaultdict(set)
    for d, w in enumerate(words):
        for j in range(len(w) - n + 1):
            held[tuple(w[j:j + n])].add(d)
    out = []
    for d, w in enumerate(words):
        on = np.zeros(len(w), bool)
        for j in range(len(w) - n + 1):
            if len(held[tuple(w[j:j + n])]) > 1:
                on[j:j + n] = True
        out.append(int(on.sum()))
    return out


@pytest.mark.parametrize("group", [20_000, 2])
def test_repeats_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP_ROWS", group)
    rng, texts = random.Random(7), []
    passages = [prose(500 + i, rng.randint(12, 40)) for i in range(6)]
    for i in range(60):
        parts = [prose(i, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages).split()
            a = rng.randint(0, 8)
            parts += [" ".join(p[a:]), prose(1000 + 7 * i + len(parts), rng.randint(0, 10))]
        texts.append((i, " ".join(parts)))
    texts += [(60, texts[5][1]), (61, "z " * 90), (62, "z " * 40)]
    got = {r["doc_id"]: r["n_repeated"] for r in repeats.repeated_passages(docs_of(spark, texts), 15).collect()}
    assert got == {i: n for (i, _), n in zip(texts, brute_repeats(texts, 15)) if n}


def test_repeats_on_awkward_rows(spark):
    got = sorted((r["doc_id"], r["n_repeated"]) for r in repeats.repeated_passages(awkward(spark), 50).collect())
    want = sorted((i, n) for (i, t), n in zip(AWKWARD, brute_repeats(AWKWARD, 50)) if n)
    assert got == want and (1, 80) in got
    assert repeats.repeated_passages(empty(spark), 50).count() == 0


# ---- 5 nearest neighbours ----------------------------------------------------------
def brute_nearest(rows, queries, k):
    out = []
    for q, x in queries:
        d = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))), i) for i, y in rows if i != q and len(y) == len(x))
        out += [(q, n + 1, i) for n, (_, i) in enumerate(d[:k])]
    return sorted(out)


def test_neighbours_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(knn, "CANDIDATE_ROWS", 40)
    monkeypatch.setattr(knn, "QUERY_ROWS", 3)
    monkeypatch.setattr(knn, "PAIRS", 50)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]                      # ties
    bad = [(500, None), (501, [0.0] * 8), (502, [1.0, None] + [0.0] * 6), (503, [float("inf")] + [0.0] * 7),
           (504, [float("nan")] + [1.0] * 7), (505, []), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad + rows[:20] + [(600, [1.0, 2.0])], "vec_id long, embedding array<float>")
    df = df.withColumn("score", F.lit(1)).withColumn("slot", F.lit("own"))
    got = knn.nearest(df.filter("vec_id % 30 = 0"), df, 10)
    want = brute_nearest(rows + [(600, [1.0, 2.0])], [r for r in rows if r[0] % 30 == 0], 10)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()) == want
    few = df.filter("vec_id < 4")
    assert knn.nearest(few, few, 10).count() == 12
    assert knn.nearest(df.limit(0), df, 10).count() == knn.nearest(few, df.limit(0), 10).count() == 0


# ---- 6 token counts -------------------------------------------------------------------
def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    rng = random.Random(6)
    parts = list("ab cd'st  \n\t\r\x1c\x1f\x85\xa0 　é1٣你\U0001f600-!?.<|>") + ["<|endoftext|>", "'ll", "aaaa", "  ", "1000"]
    odd = [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(3000)]
    texts = AWKWARD + odd + [(90, "-" * 5001), (91, "the " * 300), (92, "<|endoftext|>")]
    got = collections.Counter(tuple(r) for r in tokens.token_counts(docs_of(spark, texts), path, 512).collect())
    n = [len(e.ids) for e in lib.encode_batch([t or "" for _, t in texts], add_special_tokens=False)]
    assert got == collections.Counter((i, len((t or "").encode()), k, k > 512) for (i, t), k in zip(texts, n))
    assert tokens.token_counts(empty(spark), path).count() == 0


# ---- 7 line dedup -----------------------------------------------------------------------
def test_boilerplate_lines(spark):
    rows, sources = [], {}
    for i in range(40):
        rows.append((i, "\n".join([f"own {i}", "on all sites ", "", " shared" if i < 9 else f"x{i}", "ten" if i < 10 else "y"])))
        sources[i] = f"site{i}"
    rows += [(50, None), (51, ""), (52, "on all sites"), (None, "ten\nown")]
    sources |= {50: "site0", 51: None, 52: None, None: None}
    d = docs_of(spark, rows, sources).withColumn("n_removed", F.lit("own")).withColumn("line", F.lit("own"))
    out = {r["doc_id"]: r for r in lines.remove_boilerplate(d, min_sites=10).collect()}
    assert out[3]["text"] == "own 3\n\n shared" and (out[3]["n_lines"], out[3]["n_removed"]) == (4, 2)
    assert out[20]["text"] == "own 20\n\nx20"
    assert out[50]["text"] is None and out[51]["text"] == "" and out[52]["text"] == "" and out[None]["text"] == "own"
    assert lines.remove_boilerplate(empty(spark)).count() == 0


# ---- 8 decontamination ---------------------------------------------------------------------
def test_overlaps_equal_brute_force(spark):
    rng = random.Random(8)
    items = [(i, prose(2000 + i, rng.randint(12, 40))) for i in range(15)] + [(15, prose(2015, 7)), (16, "two words"), (17, None), (18, "")]
    texts, planted = [], set()
    for i in range(50):
        t = prose(i, 100).split()
        if i % 5 == 0:
            j = (i // 5) % 16
            p = items[j][1].split()
            if len(p) >= 20:
                for s in range(4, len(p), 9):     # substitutions
                    p[s] = "other"
            t[40:40] = [w.upper() + "," for w in p]
            planted.add((i, j))
        texts.append((i, " ".join(t)))
    others = [(None if i is None else 100 + i, t) for i, t in AWKWARD]
    d = docs_of(spark, texts + others).withColumn("item_id", F.lit("own")).withColumn("row", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("mask", F.lit("own"))
    got = decontam.overlaps(d, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == planted
    words = {i: words_of(t) for i, t in texts}
    for r in got:
        item = words_of(dict(items)[r["item_id"]])
        seg = words[r["doc_id"]][r["doc_from"]:r["doc_to"]]
        same = sum(x == y for x, y in zip(seg, item[r["item_from"]:]))
        assert same == r["n_equal"] and same >= 0.8 * len(seg) and len(seg) >= min(10, len(item))
    kept = [x["doc_id"] for x in decontam.decontaminate(d, b).collect()]
    dropped = {i for i, _ in planted}
    assert sorted(map(str, kept)) == sorted(str(i) for i, _ in texts + others if i not in dropped)
    assert decontam.overlaps(d, b.limit(0)).count() == 0 and decontam.decontaminate(empty(spark), b).count() == 0


def substituted(words, places):
    return [f"other{i}" if i in places else w for i, w in enumerate(words)]


def test_diagonal_overlaps_equal_a_search_of_all_segments():
    rng = random.Random(81)
    for trial in range(400):
        n, share = rng.randint(10, 45), rng.choice([0.8, 0.8, 0.9, 0.7, 1.0])
        same = [rng.random() < rng.choice([0.5, 0.8, 0.9]) for _ in range(n)]
        item, shift = np.arange(1, n + 1, dtype=np.uint64), rng.randint(0, 5)
        doc = np.concatenate([np.full(shift, 999, np.uint64), np.where(same, item, np.uint64(0))])
        got = decontam.diagonal_overlaps(doc, item, shift, 10, share)
        least = round(share * 10)
        whole = [(a, z) for a in range(n) for z in range(a + 10, n + 1) if 10 * sum(same[a:z]) >= least * (z - a)]
        assert all((a, z) in whole and k == sum(same[a:z]) for a, z, k in got)
        assert all(any(a < y and x < z for x, y, _ in got) for a, z in whole)
        assert max((z - a for a, z, _ in got), default=0) == max((z - a for a, z in whole), default=0)
        assert all(p[1] <= q[0] for p, q in zip(got, got[1:]))


def test_overlaps_with_substituted_words(spark):
    ten, twenty, two = (prose(3000 + i, n).split() for i, n in enumerate((10, 20, 60)))
    apart = substituted(two, set(range(15, 45)))
    texts = [(1, substituted(ten, {3})), (2, substituted(twenty, {5, 10, 15})), (3, apart)]
    d = docs_of(spark, [(i, " ".join(["left"] * 20 + t + ["right"] * 20)) for i, t in texts])
    b = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate((ten, twenty, two), 1)], "item_id long, text string")
    got = sorted(tuple(r)[2:] for r in decontam.overlaps(d, b).select(
        "doc_id", "text_key", "item_id", "item_from", "n_equal", "doc_from").collect())
    assert [r[:3] for r in got] == [(1, 0, 9), (2, 0, 17), (3, 0, 15), (3, 42, 15)]


def test_masks_fit_every_overlap():
    # 20 words or more split into parts of 10 to 19, one of which has the share
    kept = [[j for j, c in enumerate(m) if c == "1"] for m in decontam.MASKS]
    for n in range(10, 20):
        places = [{s + j for j in k} for m, k in zip(decontam.MASKS, kept) for s in range(n - len(m) + 1)]
        for bad in itertools.combinations(range(n), n // 5):
            assert any(p.isdisjoint(bad) for p in places), (n, bad)


def test_overlaps_with_two_substitutions_in_ten_words(spark):
    cases = [(10, {0, 9}), (10, {3, 5}), (15, {5, 7, 9}), (50, set(range(4, 50, 5))), (50, set(range(0, 50, 5)))]
    items = [prose(4000 + i, n).split() for i, (n, _) in enumerate(cases)]
    d = docs_of(spark, [(i, " ".join(["left"] * 9 + substituted(t, bad) + ["right"] * 9))
                        for i, (t, (_, bad)) in enumerate(zip(items, cases))])
    b = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["doc_from"], r["doc_to"], r["n_equal"]) for r in decontam.overlaps(d, b).collect())
    assert got == [(i, i, 9, 9 + n, n - len(bad)) for i, (n, bad) in enumerate(cases)]


# ---- 9 similarity join ----------------------------------------------------------------------
def brute_classes(texts, k=5, least=0.8):
    sets = []
    for _, t in texts:
        w = words_of(t)
        m = min(k, max(1, len(w)))
        sets.append(frozenset(tuple(w[j:j + m]) for j in range(len(w) - m + 1)) if w else None)
    n, parent = len(texts), list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = collections.defaultdict(set)
    for a in range(n):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
                if sets[a] != sets[b]:
                    links[a].add(sets[b])
                    links[b].add(sets[a])
    group = collections.defaultdict(list)
    for i in range(n):
        group[root(i)].append(texts[i][0])
    least_id = {r: min((x for x in ids if x is not None), default=None) for r, ids in group.items()}
    return sorted(((texts[i][0], least_id[root(i)], len(links[i])) for i in range(n)), key=str)


@pytest.mark.parametrize("blocks", [(4096, 512, 64), (8, 5, 4)])
def test_classes_equal_brute_force(spark, monkeypatch, blocks):
    for name, value in zip(("BUCKET_BLOCK", "BLOCK", "LEAF"), blocks):
        monkeypatch.setattr(setjoin, name, value)
    rng, texts = random.Random(9), list(AWKWARD)
    for g in range(8):
        base = prose(3000 + g, rng.randint(40, 120)).split()
        for c in range(rng.randint(1, 14)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 45))):
                t[rng.randrange(len(t))] = rng.choice(VOCAB)
            texts.append((100 + 20 * g + c, " ".join(t)))
    d = docs_of(spark, texts).withColumn("node", F.lit("own")).withColumn("class_id", F.lit(1))
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in setjoin.similarity_classes(d).collect()), key=str)
    assert got == brute_classes(texts)
    assert setjoin.runs_for(0.9995, 0.8) >= 10


def test_one_document_of_each_class_stays(spark):
    d = awkward(spark)
    kept = collections.Counter(r["doc_id"] for r in setjoin.keep_one(d).collect())
    assert kept == {1: 2, 3: 1, 4: 1, 5: 1, None: 1, 6: 1, 7: 1, 8: 1, 10: 1}
    assert setjoin.keep_one(empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(10)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    e = spark.createDataFrame(edges + [(None, 1), (5, 5)], "a long, b long")
    got = {r["id"]: r["component"] for r in connected_components(e).collect()}
    label = {x: x for p in edges for x in p if p[0] != p[1]}
    for _ in range(80):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


# ---- 10 mixing ------------------------------------------------------------------------------
def poisson_count(u, rate):
    k, p = 0, math.exp(-rate)
    c = p
    while c <= u and k < 10_000:
        k += 1
        p *= rate / k
        c += p
    return k


def test_copies_follow_the_poisson_inverse(spark):
    texts = [(i, prose(i, 5 + i % 40)) for i in range(400)]
    d = docs_of(spark, texts, {i: "big" if i % 3 else "small" for i in range(400)})
    weights = {"big": 1.0, "small": 3.0}
    chars = collections.Counter()
    for i, t in texts:
        chars["big" if i % 3 else "small"] += len(t)
    out = collections.Counter(r["doc_id"] for r in mixing.poisson_mix(d, weights=weights, epochs=2.0, seed=3).collect())
    for i, _ in texts:
        s = "big" if i % 3 else "small"
        rate = 2.0 * weights[s] / 4.0 * sum(chars.values()) / chars[s]
        u = int(hashlib.md5(f"3:{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert out[i] == poisson_count(u, rate)
    assert mixing.poisson_cdf(2000.0)[-1] == pytest.approx(1.0) and mixing.poisson_cdf(0.0).tolist() == [1.0]


def test_mixing_awkward_rows(spark, monkeypatch):
    d = awkward(spark)
    a = mixing.poisson_mix(d, epochs=3.0, copy_col="_c", order_col="_o")
    assert set(d.columns) < set(a.columns)
    rows = sorted((str(r["doc_id"]), r["_c"], r["_o"]) for r in a.collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)      # the salted join gives the same
    again = sorted((str(r["doc_id"]), r["_c"], r["_o"]) for r in
                   mixing.poisson_mix(d, epochs=3.0, copy_col="_c", order_col="_o").collect())
    assert rows == again and len(rows) > 0
    assert mixing.poisson_mix(empty(spark)).count() == 0


def test_words_are_normal():
    assert words_of("Ab, c-d !! ÉT") == ["ab", "cd", "ét"] and normal("--") == "" and words_of(None) == []
