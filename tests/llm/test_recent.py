"""The memory of operator 9's workers: bounded, and without influence on results."""

import functools
import random

from tessera.llm import bpe


def test_generations():
    seen = bpe.Recent(3)
    assert sorted(seen.missing({"a", "b"})) == ["a", "b"]
    seen.young.update(a=1, b=2, c=3, d=4)
    assert seen.missing({"a", "x"}) == ["x"] and seen.young == {"a": 1} and set(seen.old) == {"a", "b", "c", "d"}
    seen.young.update(x=5, y=6, z=7)
    # The first generation is forgotten but for "a", which was met again.
    assert sorted(seen.missing({"b", "c"})) == ["b", "c"] and seen.missing({"a", "x"}) == [] and seen.young == {"a": 1, "x": 5}


def test_small_memory_gives_equal_ids(monkeypatch):
    r = random.Random(8)
    words = ["".join(r.choice("abcdé ñ,.") for _ in range(r.randrange(1, 12))) for _ in range(400)]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(60))) for _ in range(200)] + ["", None]
    whole = bpe.encode_texts(texts)
    monkeypatch.setattr(bpe, "_merged", functools.lru_cache(lambda path: bpe.Recent(5)))
    few = bpe.Chunks(functools.partial(bpe.encode_chunks, path=bpe.VOCABULARY), 7)
    assert [x for k in range(0, len(texts), 9) for x in few.texts(texts[k : k + 9])] == whole
    import public_tokenizers
    import tiktoken

    model = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(bpe.VOCABULARY), special_tokens={})
    assert all(bytes(x) == b"".join(i.to_bytes(4, "little") for i in model.encode_ordinary(t or "")) for x, t in zip(whole, texts))
