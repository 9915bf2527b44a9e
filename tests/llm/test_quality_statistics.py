"""Statistics of a text against plain Python."""

import random
import re

import pytest

from keelson.llm import quality as Q

TEXTS = ["", " ", "a", "!", "##", "a##b#c%%%", "!! ??", "\n", "x  y ", " é!!é\t#", "the the le A9 -- \U0001f600"] + [
    "".join(random.Random(i).choices("#!% aZé9.|", k=i % 40 + 1)) for i in range(300)]


def test_ratios_equal_plain_python():
    for t in TEXTS:
        _, distinct, s = Q.statistics(t)
        words, runs = Q.plain_words(t), t.split()
        assert set(distinct) == set(words)
        assert Q.mark_runs(t) == len(re.findall(r"[!#$%&*=~^|]{2,}", t))
        assert s["function"] == pytest.approx(sum(w in Q.FUNCTION_WORDS for w in words) / max(1, len(words)))
        assert s["bare"] == pytest.approx(sum(not any(c.isalpha() or c.isdigit() for c in w) for w in runs) / max(1, len(runs)))
