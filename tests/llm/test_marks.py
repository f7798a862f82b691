"""Marks of hashes: rows that surely meet nothing in a join stay where they are."""

import numpy as np
import pyarrow as pa
import xxhash

from tessera.llm import sparse_suffix, words
from tessera.llm.shared import marked, marks


def test_marks_lose_nothing(spark):
    own = [xxhash.xxh3_128_digest(str(k).encode()) for k in range(3000)]
    gram = [int.from_bytes(x[8:], "little", signed=True) for x in own]
    rows = spark.createDataFrame([(g, bytearray(o)) for g, o in zip(gram[:500], own[:500])], "gram long, own binary").repartition(5)
    for key, values in (("gram", pa.array(gram)), ("own", pa.array(own, pa.binary()))):
        found = marked(marks(rows, key), values)
        assert found[:500].all() and found[500:].sum() < 5
        assert not marked(marks(rows.limit(0), key), values).any()


def test_texts_without_repeats_are_not_moved(spark):
    said = " ".join(f"w{k}" for k in range(60))
    rows = [(k, " ".join(f"x{k}y{j}" for j in range(70)) + (" " + said if k < 2 else "")) for k in range(40)] + [(None, None), (7, "")]
    docs = spark.createDataFrame(rows, "id long, text string")
    kept = sparse_suffix.suffixes(docs)
    often = kept.groupBy("gram").count().where("count > 1")
    moved = sparse_suffix._marked(kept, "gram", marks(often, "gram"))
    assert 0 < moved.count() < kept.count() / 4
    packed = sparse_suffix._packed(docs, marks(moved, "own"))
    assert sorted(r["id"] for r in packed.collect()) == [0, 1]
    left = {(r["id"], r["text"]) for r in sparse_suffix.remove(docs, "id").collect()}
    assert left == {(k, t if k != 1 else t.removesuffix(said)) for k, t in rows}


def test_hashing_keeps_little(corpus):
    words._powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    words.words(corpus, words.SPACED)
    assert sum(p.nbytes for p in words._powers) <= 6_000_000
