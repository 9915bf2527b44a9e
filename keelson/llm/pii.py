"""Personal data: base patterns and a linear-chain conditional random field.

The base patterns find emails, addresses, cards and phones in their plain
form.  The field adds written-around forms (``name (at) host (dot) org``,
``555-010-1234``, ``10[.]0[.]0[.]1``): it labels pieces of text by word-shape
features, is trained from a small labelled table and decoded by Viterbi over
numpy batches.  Only words with a digit, an at sign or a bracketed at / dot
(and their neighbours there) may carry a label; all other words are outside,
which cuts the chain exactly, so just the stretches between are decoded.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")

# ---- base patterns ----------------------------------------------------------
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins; the look-behinds say so
# and keep long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,}")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def part_fits(part: str) -> bool:
    """A number of any length is at most 255."""
    p = part.lstrip("0")
    return len(p) <= 3 and int(p or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, in order."""
    out, end = [], 0
    for m in EMAIL_TAIL.finditer(text) if "@" in text else ():
        s = m.start()
        while s > end and text[s - 1] in LOCAL:
            s -= 1
        if s < m.start():
            end = m.end()
            out.append((0, s, end))
    if DIGIT.search(text):
        out += [(1, *m.span()) for m in IP.finditer(text) if all(part_fits(p) for p in m[0].split("."))]
        for m in CARD.finditer(text):
            d = digits(m[0])
            if len(d) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return out


# ---- the small labelled table -----------------------------------------------
# {kind} stands for a form of that kind; # is a digit, w a word, h a hex digit,
# A a capital.  Fixed values.
FORMS = {
    "phone": ("(###) ###-####", "###-###-####", "### ### ####", "1-###-###-####", "###.###.####", "0## ### ####",
              "00## ### ######", "1 (###) ###-####"),
    "email": ("w (at) w (dot) com", "w[at]w[dot]org", "w [at] w [dot] net", "w.w (at) w.com", "w(at)w.org",
              "w.## [at] w [dot] com", "w at w[dot]com"),
    "ip": ("##[.]##[.]##[.]##", "1##[.]##[.]#[.]##", "##(.)1##(.)##(.)#", "##[.]1##[.]1##[.]##"),
    "card": ("####.####.####.####", "####/####/####/####", "####_####_####_####", "####.######.#####"),
}
LINES = (
    "call {phone} w", "phone: {phone}.", "tel {phone} w w", "my number is {phone}, w", "w w {phone} w w", "w, {phone}. w",
    "reach me on {phone} w", "fax {phone}", "{phone}", "mail {email} w", "email: {email}.", "write to {email}, w",
    "w w {email} w w", "{email}", "contact {email} w", "host {ip} w", "address: {ip}.", "w w {ip} w", "{ip}", "ip {ip}, w",
    "card {card} w", "w w {card}, w", "visa: {card}.", "{card}",
    "w w w w", "version #.# w", "w BY-NC #.#.", "w version #.", "token = \"hhhhhhhhhhhhhhhhhhhhhhhh\" w", "password=hhhhhhhhhhhh w",
    "w AAAAA##AAA#AAAA w", "order ######## w", "on ####-##-## at ##:## w", "on ##.##.#### w", "price ##.## w", "w ### w",
    "isbn ###-#-##-######-# w", "pages ###-### w", "id ################ w", "in #### w w", "## of ## w", "chapter #.#.# w",
    "w (see #) w", "w [#] w", "#,###,### w", "w #-# w", "w at ## w", "w @ w", "w (w) w", "####-####", "w ### ## w", "##:##:## w",
    "w ##-#### w", "#.#.#.# w", "w-## w", "w##w w", "(at) w w", "w [dot] w", "############ w", "######### w")


def fill(pattern: str, rng: np.random.Generator) -> str:
    def one(c: str) -> str:
        if c == "w":
            return "".join(rng.choice(list("abcdefghilmnoprstuv"), rng.integers(2, 9)))
        return {"#": lambda: str(rng.integers(10)), "h": lambda: rng.choice(list("0123456789abcdef")),
                "A": lambda: rng.choice(list("ABCDEFGHKLMNPQRSTUVW"))}.get(c, lambda: c)()
    # w, h and A stand alone or among placeholders only; words of the line stay
    return re.sub(r"(?<![a-z])w(?![a-z])|#|(?<![a-z])h{6,}|A{3,}(?=[A#])|(?<=#)A+",
                  lambda m: "".join(one("h" if set(m[0]) == {"h"} else c) for c in m[0]), pattern)


def labelled_table(copies: int = 14, seed: int = 5) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """(text, spans) rows: every line with random forms filled in."""
    rng, rows = np.random.default_rng(seed), []
    for _ in range(copies):
        for line in LINES:
            m = re.search(r"\{(\w+)\}", line)
            if not m:
                rows.append((fill(line, rng), []))
                continue
            forms = FORMS[m[1]]
            before, form, after = (fill(x, rng) for x in (line[:m.start()], forms[rng.integers(len(forms))], line[m.end():]))
            rows.append((before + form + after, [(KINDS.index(m[1]), len(before), len(before) + len(form))]))
    return rows


# ---- pieces, features, stretches ---------------------------------------------
PIECE = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
WORD = re.compile(r"\S+")
BRACKET = re.compile(r"[\[({<](?:at|dot|\.|@)[\])}>]", re.IGNORECASE)
TRIGGER = re.compile(r"[0-9@]|[\[({<](?:at|dot|\.)[\])}>]", re.IGNORECASE)
# Words that hint at a kind (fixed values).
CUES = frozenset("call phone tel number fax reach mail email write contact host address ip card visa mastercard "
                 "version order id isbn pages chapter price token password on in at dot com org net".split())
CONTEXT = 2           # words beside a stretch that features see
CELLS = 1 << 15       # pieces decoded at once, with padding
LABELS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]


def piece_shape(p: str) -> str:
    if p[0] in "0123456789":
        return f"d{min(len(p), 9)}"
    if p[0].isalpha():
        low = p.lower()
        return low if low in CUES else ("A" if p.isupper() else "Aa" if p[0].isupper() else "a") + ("" if len(p) > 3 else str(len(p)))
    return p


def stretches(text: str) -> Iterator[list[tuple[int, int, bool]]]:
    """Pieces (start, end, may carry a label) of each stretch of a line."""
    at = 0
    while True:
        m = TRIGGER.search(text, at)
        if m is None:
            return
        lo, hi = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.start())
        hi = len(text) if hi < 0 else hi
        words = [w.span() for w in WORD.finditer(text, lo, hi)]
        may = np.array([TRIGGER.search(text, a, b) is not None for a, b in words])
        joint = np.array([BRACKET.search(text, a, b) is not None or text[a:b] == "@" for a, b in words])
        may[1:] |= joint[:-1]
        may[:-1] |= joint[1:]
        # a plain "at" beside such a word, and the word before it
        for i in np.flatnonzero(may[1:]):
            if text[words[i][0]:words[i][1]].lower() == "at" and "[" in text[words[i + 1][0]:words[i + 1][1]]:
                may[max(0, i - 1):i + 1] = True
        near = np.convolve(may, np.ones(2 * CONTEXT + 1), "same")[:len(may)] > 0 if len(may) else may
        run: list[tuple[int, int, bool]] = []
        for (a, b), m_, n in zip(words, may.tolist(), near.tolist()):
            if n:
                run += [(*p.span(), m_) for p in PIECE.finditer(text, a, b)]
            elif run:
                yield run
                run = []
        if run:
            yield run
        at = hi + 1


def feature_names(text: str, pieces: list[tuple[int, int, bool]]) -> list[list[str]]:
    """Word-shape features of each piece: its own and its neighbours' shapes,
    pairs of them, and whether blanks stand beside it."""
    s = ["<<", "<", *(piece_shape(text[a:b]) for a, b, _ in pieces), ">", ">>"]
    out = []
    for i, (a, b, _) in enumerate(pieces):
        gap = "_" if i and pieces[i - 1][1] < a else ""
        next_gap = "_" if i + 1 < len(pieces) and pieces[i + 1][0] > b else ""
        x = s[i + 2]
        out.append(["0" + x, "-" + s[i + 1] + gap, "+" + next_gap + s[i + 3], "=" + s[i], "*" + s[i + 4],
                    "<" + s[i + 1] + gap + x, ">" + x + next_gap + s[i + 3], "3" + s[i + 1] + gap + x + next_gap + s[i + 3],
                    "l" + s[i] + s[i + 1] + gap + x, "r" + x + next_gap + s[i + 3] + s[i + 4]])
    return out


class Field:
    """Weights of a linear chain over LABELS: ``emit`` (feature x label, row 0
    for unknown features) and ``move`` (label x label)."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    @staticmethod
    def legal() -> np.ndarray:
        """I-kind may only follow B-kind or I-kind."""
        n = len(LABELS)
        ok = np.ones((n, n), bool)
        for j, label in enumerate(LABELS):
            if label[0] == "I":
                ok[:, j] = [x[2:] == label[2:] for x in LABELS]
        return ok

    def scores(self, names: list[list[str]], may: list[bool]) -> np.ndarray:
        get = self.names.get
        idx = np.array([[get(f, 0) for f in row] for row in names], np.int64)
        e = self.emit[idx].sum(axis=1)
        e[~np.array(may, bool), 1:] = -1e9
        return e

    def decode(self, scores: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi paths of sequences, in batches of similar length."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
        order = sorted(range(len(scores)), key=lambda i: len(scores[i]))
        move = np.where(self.legal(), self.move, -1e9)
        start = np.array([-1e9 if x[0] == "I" else 0.0 for x in LABELS])
        s = 0
        while s < len(order):
            # sequences decoded together: few cells, so a very long one is alone
            z = s + 1
            while z < len(order) and z - s < 256 and (z - s + 1) * len(scores[order[z]]) <= CELLS:
                z += 1
            ids, s = order[s:z], z
            n = np.array([len(scores[i]) for i in ids])
            e = np.zeros((len(ids), int(n.max()), len(LABELS)))
            for r, i in enumerate(ids):
                e[r, :n[r]] = scores[i]
            best, back = start + e[:, 0], np.zeros(e.shape, np.int64)
            for t in range(1, e.shape[1]):
                step = best[:, :, None] + move
                back[:, t] = step.argmax(axis=1)
                new = step.max(axis=1) + e[:, t]
                best = np.where((t < n)[:, None], new, best)
            path = np.zeros(e.shape[:2], np.int64)
            path[np.arange(len(ids)), n - 1] = best.argmax(axis=1)
            for t in range(e.shape[1] - 1, 0, -1):
                r = np.flatnonzero(t < n)
                path[r, t - 1] = back[r, t, path[r, t]]
            for r, i in enumerate(ids):
                out[i] = path[r, :n[r]]
        return out


def train(table: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 120, rate: float = 0.4,
          l2: float = 2e-3) -> Field:
    """Maximum conditional likelihood by Adagrad; forward-backward over all
    sequences at once."""
    seqs, gold = [], []
    for text, spans in table:
        for pieces in stretches(text):
            seqs.append((feature_names(text, pieces), [p[2] for p in pieces]))
            y = []
            for a, b, may in pieces:
                k = next((k for k, s, e in spans if s <= a and b <= e), None) if may else None
                y.append(0 if k is None else 1 + 2 * k + (not any(a == s for q, s, e in spans if q == k)))
            # the first labelled piece of a span begins it
            y = [v - 1 if v and v % 2 == 0 and (i == 0 or y[i - 1] not in (v, v - 1)) else v for i, v in enumerate(y)]
            gold.append(y)
    names = {f: i + 1 for i, f in enumerate(sorted({f for rows, _ in seqs for row in rows for f in row}))}
    n, t_max, n_lab = len(seqs), max(len(y) for y in gold), len(LABELS)
    k = len(seqs[0][0][0])
    idx = np.zeros((n, t_max, k), np.int64)
    mask, may, y = np.zeros((n, t_max), bool), np.zeros((n, t_max), bool), np.zeros((n, t_max), np.int64)
    for r, ((rows, m), g) in enumerate(zip(seqs, gold)):
        idx[r, :len(rows)] = [[names[f] for f in row] for row in rows]
        mask[r, :len(rows)], may[r, :len(rows)], y[r, :len(rows)] = True, m, g
    emit, move = np.zeros((len(names) + 1, n_lab)), np.zeros((n_lab, n_lab))
    ge, gm = np.full(emit.shape, 1e-8), np.full(move.shape, 1e-8)
    ok = Field.legal()
    start = np.array([-1e9 if x[0] == "I" else 0.0 for x in LABELS])

    def lse(x: np.ndarray, axis: int) -> np.ndarray:
        m = x.max(axis=axis, keepdims=True)
        return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)

    for _ in range(rounds):
        e = emit[idx].sum(axis=2)
        e[..., 1:][~may] = -1e9
        mv = np.where(ok, move, -1e9)
        fw, bw = np.empty(e.shape), np.zeros(e.shape)
        fw[:, 0] = start + e[:, 0]
        for t in range(1, t_max):
            fw[:, t] = np.where(mask[:, t, None], lse(fw[:, t - 1, :, None] + mv, 1) + e[:, t], fw[:, t - 1])
        for t in range(t_max - 2, -1, -1):
            nxt = lse(mv[None] + (e[:, t + 1] + bw[:, t + 1])[:, None, :], 2)
            bw[:, t] = np.where(mask[:, t + 1, None], nxt, bw[:, t + 1])
        z = lse(fw[:, -1], 1)
        p = np.exp(fw + bw - z[:, None, None])
        err = np.where(mask[..., None], p - np.eye(n_lab)[y], 0.0)
        g_emit = np.zeros(emit.shape)
        for f in range(k):
            for lab in range(n_lab):
                g_emit[:, lab] += np.bincount(idx[..., f].ravel(), err[..., lab].ravel(), len(emit))
        g_emit[0] = 0
        g_move = np.zeros(move.shape)
        for t in range(1, t_max):
            on = mask[:, t]
            pair = np.exp(fw[on, t - 1, :, None] + mv + (e[on, t] + bw[on, t])[:, None, :] - z[on, None, None])
            g_move += pair.sum(axis=0)
            np.add.at(g_move, (y[on, t - 1], y[on, t]), -1.0)
        g_emit = g_emit / n + l2 * emit / 10
        g_move = g_move / n + l2 * move / 10
        ge += g_emit ** 2
        gm += g_move ** 2
        emit -= rate * g_emit / np.sqrt(ge)
        move -= rate * g_move / np.sqrt(gm)
    return Field(names, emit, move)


@functools.lru_cache(maxsize=1)
def trained() -> Field:
    return train(labelled_table())


def plausible(kind: int, s: str) -> bool:
    """What a labelled stretch must hold to be given out."""
    n = len(digits(s))
    if kind == 0:
        return bool(re.search(r"[\[({<](?:at|@)[\])}>]|@|\bat\b", s, re.IGNORECASE) and re.search(r"dot|\.", s, re.IGNORECASE)) and len(s) <= 120
    if kind == 1:
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(map(part_fits, parts))
    return 13 <= n <= 19 if kind == 2 else 7 <= n <= 15


def field_spans(field: Field, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) that the field finds in each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    where, scores = [], []
    for i, text in enumerate(texts):
        for pieces in stretches(text):
            where.append((i, pieces))
            scores.append(field.scores(feature_names(text, pieces), [p[2] for p in pieces]))
    for (i, pieces), path in zip(where, field.decode(scores)):
        t, n = 0, len(pieces)
        while t < n:
            if path[t] % 2 == 1:
                kind, z = int(path[t] // 2), t + 1
                while z < n and path[z] == path[t] + 1:
                    z += 1
                a, b = pieces[t][0], pieces[z - 1][1]
                if plausible(kind, texts[i][a:b]):
                    out[i].append((kind, a, b))
                t = z
            else:
                t += 1
    return out


def all_spans(field: Field, texts: list[str]) -> Iterator[tuple[list, list]]:
    """(base spans, all spans) of each text; the field's spans that touch a
    base span are left out."""
    base = [base_spans(t) for t in texts]
    for b, extra in zip(base, field_spans(field, texts)):
        more = [x for x in extra if not any(x[1] < e and s < x[2] for _, s, e in b)]
        yield b, sorted([*b, *more])


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def pii_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row:
    counts and SHA-256 of the base spans, and all spans as kind:start:end
    (code points), by kind, then start.  A null text counts as empty; rows are
    searched each by itself, so repeated rows and null keys stay."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trained())  # bounded by the labelled table
    kind = docs.schema[key].dataType.simpleString()
    cols = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = shared.value
        for b in batches:
            rows = []
            for base, spans in all_spans(field, b["_text"].tolist()):
                count = [0] * len(KINDS)
                for k, _, _ in base:
                    count[k] += 1
                rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            out = pd.DataFrame(rows, columns=cols)
            out.insert(0, "_key", b["_key"].to_numpy())
            yield out

    out = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).mapInPandas(
        run, f"_key {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    return out.withColumnRenamed("_key", key)
