import re

import numpy as np
import pytest
from llm_fixtures import LOWER

from tessera.llm import shingles as S
from tessera.llm import words as W


@pytest.mark.parametrize("kind, pattern", [(W.SPACED, r"[^\x20\x09-\x0D]+"), (W.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_are_told_apart(corpus, kind, pattern):
    found = W.words(corpus, kind)
    name = {}
    for k, t in enumerate(corpus):
        said = re.findall(pattern, (t or "").translate(LOWER))
        own = found.hash[found.first[k]:found.first[k + 1]].tolist()
        assert len(said) == len(own)
        for a, b in zip(said, own):
            assert name.setdefault(a, b) == b
    assert len(set(name.values())) == len(name)


def test_grams_depend_on_order():
    h = np.array([3, 5, 3, 5, 3, 9], np.uint64)
    for n in (2, 6):
        g = W.grams(h, n)
        assert len(g) == 7 - n
    a, b = W.grams(np.array([1, 2], np.uint64), 2), W.grams(np.array([2, 1], np.uint64), 2)
    assert a[0] != b[0] and W.grams(h, 2)[0] == W.grams(h, 2)[2] and len(W.grams(h, 9)) == 0


def test_shingles(corpus):
    s = S.shingles(corpus, 4)
    for k, t in enumerate(corpus):
        w = (t or "").translate(LOWER).split()
        assert s.n[k] == (len({tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))}) if w else 0)
    sig = s.signatures()
    assert sig[4] == sig[5] and sig[6] != sig[7]
    assert S.common(s, s).tolist() == s.n.tolist()
