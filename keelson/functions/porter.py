"""Porter (1980) suffix-stripping stemmer, as a small per-word helper.

It is only ever applied to the DISTINCT tokens of a corpus (a vocabulary,
not the text), through an Arrow-batched pandas UDF; stems are joined back
to the token rows by Spark.  The rule tables below follow the published
algorithm (with the two departures of the widely used reference C version:
'bli' -> 'ble' and 'logi' -> 'log')."""

from __future__ import annotations

# The published suffix rules, in the algorithm's order.
STEP2_RULES = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"),
]
STEP3_RULES = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4_SUFFIXES = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

_VOWELS = frozenset("aeiou")


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """Number of vowel-consonant sequences in the stem ([C](VC){m}[V])."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        c = _is_cons(stem, i)
        if c and prev_vowel:
            m += 1
        prev_vowel = not c
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    """consonant-vowel-consonant ending, the last not w, x or y."""
    n = len(w)
    return (n >= 3 and _is_cons(w, n - 1) and not _is_cons(w, n - 2) and _is_cons(w, n - 3)
            and w[-1] not in "wxy")


def _step1ab(w: str) -> str:
    if w.endswith("s"):
        if w.endswith("sses"):
            w = w[:-2]
        elif w.endswith("ies"):
            w = w[:-2]
        elif not w.endswith("ss"):
            w = w[:-1]
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
        return w
    for suf in ("ed", "ing"):
        if w.endswith(suf) and _has_vowel(w[:-len(suf)]):
            w = w[:-len(suf)]
            if w.endswith(("at", "bl", "iz")):
                return w + "e"
            if _double_cons(w):
                return w if w[-1] in "lsz" else w[:-1]
            if _measure(w) == 1 and _cvc(w):
                return w + "e"
            return w
    return w


def _step1c(w: str) -> str:
    if w.endswith("y") and _has_vowel(w[:-1]):
        return w[:-1] + "i"
    return w


def _replace_first(w: str, rules) -> str:
    """Apply the first rule whose suffix matches (longest listed first for a
    shared ending is not needed: rules are tried in order), if m(stem) > 0."""
    best = None
    for suf, rep in rules:
        if w.endswith(suf) and (best is None or len(suf) > len(best[0])):
            best = (suf, rep)
    if best is not None:
        stem = w[:-len(best[0])]
        if _measure(stem) > 0:
            return stem + best[1]
    return w


def _step4(w: str) -> str:
    best = None
    for suf in STEP4_SUFFIXES:
        if w.endswith(suf) and (best is None or len(suf) > len(best)):
            best = suf
    if best is None:
        return w
    stem = w[:-len(best)]
    if best == "ion" and not (stem and stem[-1] in "st"):
        return w
    return stem if _measure(stem) > 1 else w


def _step5(w: str) -> str:
    if w.endswith("e"):
        a = _measure(w[:-1])
        if a > 1 or (a == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


def stem(word: str) -> str:
    """Porter stem of a lower-case word; words of one or two letters are
    returned unchanged."""
    if word is None or len(word) <= 2:
        return word
    w = _step1ab(word)
    w = _step1c(w)
    w = _replace_first(w, STEP2_RULES)
    w = _replace_first(w, STEP3_RULES)
    w = _step4(w)
    return _step5(w)
