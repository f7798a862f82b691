import random

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table_of(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, odd white space, repeats and odd rows."""
    r = random.Random(4)
    vocabulary = [a + b for a in "ka lo mi nu re sa to vé ZU ñi".split() for b in "da fe gi ho ju ké Ly mö".split()]
    sentence = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    shared = [sentence(n) for n in (30, 49, 50, 51, 64, 90)]
    base = sentence(120).split(" ")
    texts = [None, "", " \t\n", "x", "A b", "a B", "one two three", "one two three four"]
    for k in range(60):
        parts = [sentence(r.randrange(5, 60))]
        for _ in range(r.randrange(3)):
            parts += [r.choice(shared), sentence(r.randrange(3, 30))]
        texts.append(r.choice([" ", "\n", ". ", "\t"]).join(parts))
    for _ in range(60):
        w = list(base)
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            w[r.randrange(len(w))] = r.choice(vocabulary) + "x"
        texts.append(" ".join(w))
    texts += [texts[20], texts[21].upper(), "And " * 300, "*** $$ | <b> " * 40, "same line\n" * 80]
    return texts
