"""Byte-level BPE: cutting texts where tokens cannot cross, reading the
vocabulary, and counting tokens by rank-synchronous merging of arrays.

The pre-token pattern of these vocabularies joins at most one blank to a
following word, so no token crosses from a non-blank to a blank.  Cutting
there leaves few different pieces, each of which is handled once per worker.
"""

from __future__ import annotations

import json
import re

import numpy as np

# Unicode white space, as the pre-token pattern sees it (fixed values).
BLANKS = "\t\n\x0b\x0c\r \x85\xa0  -     　"
ODD_BLANK = re.compile("[" + BLANKS.replace(" ", "").replace("\n", "") + "]")
PIECE = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")
DOUBLE = ("  ", " \n", "\n ", "\n\n")
# Letters up to U+024F with closing punctuation: one pre-token each (fixed rule).
WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]*)")
# Entries of a worker's cache of pieces.
CACHE_ENTRIES = 250_000


def is_plain(text: str) -> bool:
    """Only single blanks and line ends, each between other characters."""
    return (text != "" and text[0] not in " \n" and text[-1] not in " \n"
            and not any(d in text for d in DOUBLE) and ODD_BLANK.search(text) is None)


def added_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f).get("added_tokens", [])]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level BPE files:
    printable Latin-1 bytes stand for themselves, the others take the letters
    from U+0100 on, in order."""
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    own = set(itself)
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class MergeTable:
    """Merges of a byte-level BPE .json file: (left, right) -> rank, merged."""

    NONE = np.int32(2 ** 31 - 1)

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        left, right, both = (np.array([self.vocab[x] for x in col], np.int64) for col in (
            [a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.both = key[order], order.astype(np.int32), both[order].astype(np.int32)
        made = np.full(max(self.vocab.values()) + 1, -1, np.int64)
        made[both] = np.arange(len(pairs))
        # every merge uses symbols made by earlier merges: equal pairs of a
        # sequence can then be merged in the same round
        self.ordered = bool(((made[left] < np.arange(len(pairs))) & (made[right] < np.arange(len(pairs)))).all())

        self.of_byte = np.array([self.vocab[c] for c in byte_letters()], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], self.NONE), at

    def counts(self, pretokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token after all merges.  All sequences
        advance together: each round merges, in every sequence, its pair of
        lowest rank wherever it stands; only pairs beside a merge are looked
        up anew."""
        lens = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        out = lens.copy()
        sym = self.of_byte[np.frombuffer(b"".join(pretokens), np.uint8)]
        if len(sym) < 2:
            return out
        seq = np.repeat(np.arange(len(pretokens), dtype=np.int32), lens)
        last = np.append(seq[1:] != seq[:-1], True)     # of its sequence
        rank, at = self.ranks(sym, np.append(sym[1:], 0))
        rank[last] = self.NONE
        while True:
            starts = np.flatnonzero(np.append(True, last[:-1]))
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(sym))))
            live = low != self.NONE
            here = np.flatnonzero((rank == low) & live)
            if not len(here):
                return out
            if self.ordered:  # of overlapping places (a a a) every second one, from the left
                begins = np.append(True, np.diff(here) != 1)
                first = np.flatnonzero(begins)[np.cumsum(begins) - 1]
                here = here[(np.arange(len(here)) - first) % 2 == 0]
            else:
                here = here[np.append(True, seq[here][1:] != seq[here][:-1])]
            sym[here] = self.both[at[here]]
            out -= np.bincount(seq[here], minlength=len(out))
            last[here] = last[here + 1]
            stale = np.zeros(len(sym), bool)
            stale[here] = True
            stale[here[here > 0] - 1] = True
            live[here + 1] = False
            sym, seq, last, rank, at, stale = (x[live] for x in (sym, seq, last, rank, at, stale))
            # the symbol before a merge may have been dropped as the tail of another one
            stale[:-1] |= stale[1:] & ~last[:-1]
            anew = np.flatnonzero(stale & ~last)
            rank[anew], at[anew] = self.ranks(sym[anew], sym[anew + 1])
            rank[last] = self.NONE
            if not len(sym):
                return out


class Recent(dict):
    """A bounded cache: when full, its entries become the old ones, of which
    those asked for again stay."""

    def __init__(self):
        super().__init__()
        self.old: dict = {}

    def full(self) -> None:
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()


class TokenCounter:
    """Token counts of texts as the tokenizers library gives them for a
    byte-level BPE file: added tokens inside a text count one each, the rest
    is cut into pre-tokens by the library's rule and merged by MergeTable."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.rule = Tokenizer.from_file(path).pre_tokenizer
        self.table = MergeTable(path)
        special = added_tokens(path)
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.plain = Recent()    # piece -> tokens
        self.spaced = Recent()   # piece -> tokens of " " + piece
        self.pre = Recent()      # pre-token -> tokens

    def cut(self, piece: str, lead: str) -> list[bytes]:
        """Pre-tokens of a piece: letters with closing punctuation directly,
        anything else by the library's rule."""
        m = WORD.fullmatch(piece)
        if m:
            return [(lead + x).encode() if i == 0 else x.encode() for i, x in enumerate(m.groups()) if x]
        whole = lead + piece
        return [whole[a:b].encode() for _, (a, b) in self.rule.pre_tokenize_str(whole)]

    def learn(self, cache: Recent, pieces: set[str], lead: str) -> None:
        new = pieces.difference(cache)
        again = new.intersection(cache.old)
        cache.update((x, cache.old[x]) for x in again)
        new = list(new - again)
        if not new:
            return
        cuts = [self.cut(x, lead) for x in new]
        todo = {p for c in cuts for p in c}.difference(self.pre)
        todo = list(todo)
        self.pre.update(zip(todo, self.table.counts(todo).tolist()))
        get = self.pre.__getitem__
        cache.update((x, sum(map(get, c))) for x, c in zip(new, cuts))

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        for cache in (self.plain, self.spaced, self.pre):
            cache.full()
        extra, cuts = [0] * len(texts), []   # cuts: (text, pieces, spaced pieces)
        for i, text in enumerate(texts):
            parts = [text]
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                extra[i] += len(parts) - 1
            for part in parts:
                if is_plain(part):
                    lines = [x.split(" ") for x in part.split("\n")]
                    extra[i] += len(lines) - 1
                    cuts.append((i, [x[0] for x in lines], [w for x in lines for w in x[1:]]))
                elif part:
                    cuts.append((i, PIECE.findall(part), []))
        self.learn(self.plain, {p for _, a, _ in cuts for p in a}, "")
        self.learn(self.spaced, set().union(*(b for _, _, b in cuts)), " ")
        plain, spaced = self.plain.__getitem__, self.spaced.__getitem__
        for i, a, b in cuts:
            extra[i] += sum(map(plain, a)) + sum(map(spaced, b))
        return extra


class IdEncoder:
    """Token ids of texts as little-endian bytes, by the installed tokeniser
    (ranks file); special strings are ordinary text."""

    def __init__(self, path: str, pattern: str, dtype: str):
        import base64

        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.dtype = np.dtype(dtype)
        self.line_end = self.one("\n")
        self.plain, self.spaced = _IdCache(self, ""), _IdCache(self, " ")

    def one(self, piece: str) -> bytes:
        return np.array(self.enc.encode_ordinary(piece), self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not is_plain(text):
            return b"".join(map(self.plain.__getitem__, PIECE.findall(text)))
        out = []
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(self.plain[words[0]] + b"".join(map(self.spaced.__getitem__, words[1:])))
        return self.line_end.join(out)


class _IdCache(Recent):
    def __init__(self, encoder: IdEncoder, lead: str):
        super().__init__()
        self.encoder, self.lead = encoder, lead

    def __missing__(self, piece: str) -> bytes:
        self.full()
        out = self.old.get(piece)
        if out is None:
            out = self.encoder.one(self.lead + piece)
        if len(piece) <= 64:
            self[piece] = out
        return out
