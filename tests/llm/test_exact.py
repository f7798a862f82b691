"""Operators 1, 5, 9, 6 and 10 against brute force."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from llm_fixtures import LOWER, table_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import bpe, decontaminate, host_rules, ngram_join, wavelet


def _windows(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def _hits(texts, items):
    found = collections.defaultdict(set)
    for i, t in items:
        w = _windows(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            found[tuple(w[k:k + 10])].add(i)
    for t in texts:
        w, hit, ids = _windows(t), set(), set()
        for n in {len(x) for x in found}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in found:
                    hit |= set(range(p, p + n))
                    ids |= found[tuple(w[p:p + n])]
        yield len(w), len(hit), sorted(x for x in ids if x is not None)


@pytest.mark.parametrize("block, shard", [(8_000_000, 4_000_000), (300, 2_000)])
def test_op1_hits(spark, corpus, block, shard):
    texts = corpus + [corpus[30]]
    long_ = " ".join(corpus[30].split()[:37])
    items = [(1, long_), (2, corpus[41]), (2, corpus[41]), (3, None), (4, ""), (5, "ZUda"), (6, "kada lofe"), (None, corpus[12]), (7, long_)]
    docs = table_of(spark, texts).withColumn("hits", F.lit("taken")).withColumn("n_words", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.find(docs, bench, block_bytes=block, shard_bytes=shard).withColumn("n", decontaminate.n_hit()).collect()}
    for k, want in enumerate(_hits(texts, items)):
        assert (got[k]["n_words"], got[k]["n"], got[k]["items"]) == want, k
    whole = {m["item_id"]: m for m in got[30]["matches"]}[1]
    assert (whole["doc_start"], whole["item_start"], whole["length"]) == (0, 0, len(_windows(long_)))
    clean = decontaminate.clean(docs, bench, block_bytes=block, shard_bytes=shard)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {k for k, (_, n, _) in enumerate(_hits(texts, items)) if not n}
    assert decontaminate.find(docs.limit(0), bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(texts)


def _groups(texts, size, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    group = list(range(len(texts)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                one, two = sorted((root(i), root(j)))
                group[two] = one
    return [(len(s), root(k)) for k, s in enumerate(sets)]


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_op5_groups(spark, corpus, size, percent):
    docs = table_of(spark, corpus + corpus[-70:]).withColumn("sig", F.lit("taken"))
    want = _groups(corpus + corpus[-70:], size, percent)
    got = {r["doc_id"]: r for r in ngram_join.groups(docs, size=size, percent=percent).collect()}
    assert [(got[k]["n_shingles"], got[k]["component_id"]) for k in range(len(want))] == want
    left = ngram_join.representatives(docs, size=size, percent=percent)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [k for k, (_, c) in enumerate(want) if c == k]


def test_op5_odd_tables(spark):
    odd = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, None), (2, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in ngram_join.groups(odd).collect())
    assert got == [("1", 2, 1), ("1", 2, 1), ("2", 0, 2), ("2", 0, 2), ("None", 2, 1)]
    assert sorted(r["doc_id"] for r in ngram_join.representatives(odd).collect()) == [1, 2]
    assert ngram_join.groups(odd.limit(0)).count() == 0


TEXTS = ["", "a", "'s don't  we'll\n\n  x", "日本語 текст ñandú", "ab" * 3000, " " * 50 + "z", "\x1c\x85​﻿\U0001f600!?", "1234567 12.5", "a <|endoftext|>b", "tail  <|endoftext|>"]


def test_op9_ids(spark, corpus):
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(bpe.VOCABULARY), special_tokens={})
    texts = TEXTS + corpus
    docs = table_of(spark, texts).withColumn("decoded", F.lit(1)).withColumn("ids", F.lit("taken"))
    got = {r["doc_id"]: bytes(r["ids"]) for r in bpe.encode(docs).collect()}
    for k, t in enumerate(texts):
        assert np.frombuffer(got[k], "<u4").tolist() == own.encode_ordinary(t or ""), t
    back = bpe.decode(bpe.encode(docs)).collect()
    assert all(bytes(r["decoded"]).decode() == (texts[r["doc_id"]] or "") for r in back) and len(back) == len(texts)
    assert bpe.encode(docs.limit(0)).count() == 0


def test_op9_trees_agree():
    rank = bpe.ranks(bpe.VOCABULARY)
    pieces = [w.encode() for w in "aaaaaaa abababab unbelievable thththth antidisestablishment".split()]
    for width in (32, 64):
        assert [np.frombuffer(x, "<u4").tolist() for x in bpe.merge_many(pieces, width, bpe.VOCABULARY)] == [bpe.merge(p, rank) for p in pieces]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_op6_wavelet_matrix(n):
    ids = np.random.default_rng(n).integers(0, 50257, n).astype(np.uint32)
    ids[: n // 3] = 7
    w, _ = wavelet.unpack(wavelet.pack(ids, np.array([0, n]), 16))
    assert (w.values() == ids).all() and (n == 0 or (w.access(np.arange(n)) == ids).all())
    for v in {7, 50000, *ids[-3:].tolist()}:
        assert w.count(v) == (ids == v).sum() and w.rank(v, n // 2) == (ids[: n // 2] == v).sum()
        assert w.select(v).tolist() == np.flatnonzero(ids == v).tolist()


def test_op6_shards(spark, corpus, tmp_path):
    texts = TEXTS + corpus
    path = str(tmp_path / "shards")
    wavelet.write(table_of(spark, texts).orderBy(F.desc("doc_id")), path, block_tokens=700)
    shards = wavelet.read(spark, path)
    assert shards.count() > 5
    own, start = Tokenizer.from_file(P.path(wavelet.VOCABULARY)), 0
    got = {r["doc_id"]: r for r in wavelet.documents(shards).collect()}
    want = []
    for k, t in enumerate(texts):
        ids = own.encode(t or "", add_special_tokens=False).ids + [0]
        assert got[k]["start"] == start and zlib.crc32(np.array(ids, "<u4").tobytes()) == zlib.crc32(bytes(got[k]["ids"])), t
        start += len(ids)
        want += ids
    token = collections.Counter(want).most_common(3)[2][0]
    places = sorted(p for r in wavelet.occurrences(shards, token).collect() for p in r["positions"])
    assert places == [p for p, x in enumerate(want) if x == token]
    wavelet.write(table_of(spark, texts).limit(0), path + "0")
    assert wavelet.documents(wavelet.read(spark, path + "0")).count() == 0


def _measures(text):
    w, seen, again = re.findall(r"[^\x20\x09-\x0D]+", text or ""), set(), 0
    where = collections.defaultdict(list)
    for i in range(len(w) - 2):
        where[tuple(w[i:i + 3])].append(i)
    hit = {p + k for ps in where.values() if len(ps) > 1 for p in ps for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    for x in lines:
        again += x in seen
        seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines), again, len(hit)


def test_op10_measures(spark, corpus):
    texts = TEXTS + corpus + ["a a a a", "x y z x y z\n\nq\nq"]
    docs = table_of(spark, texts).withColumn("n_words", F.lit("taken")).withColumn("kept", F.lit(0))
    got = host_rules.measure(docs).collect()
    for r in got:
        assert tuple(r[c] for c in host_rules.MEASURES) == _measures(texts[r["doc_id"]]), texts[r["doc_id"]]
    left = host_rules.clean(docs)
    assert left.columns == docs.columns
    for r in host_rules.judge(docs, keep=["doc_id"]).collect():
        n, _, _, _, _, again = _measures(texts[r["doc_id"]])
        assert r["base_failed"] == (n < 50 or 100 * again > 50 * n)
        assert not (r["kept"] and r["base_failed"])


def test_op10_hosts(spark):
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(k, "too short", "junk") for k in range(40)] + [(100 + k, good, "fine") for k in range(40)] + [(200, good, "junk"), (201, good, None), (202, "x", "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in host_rules.judge(docs).collect()}
    assert all(kept[100 + k] for k in range(40)) and kept[201] and not kept[200] and not kept[0]
    rate = {r["source"]: r["shrunk_rate"] for r in host_rules.judge(docs).collect()}
    assert rate["fine"] < rate["small"] < 1 and rate["junk"] > 0.8
    assert host_rules.judge(docs.limit(0)).count() == 0


def test_op9_digest_columns(spark):
    from tessera.llm import queries

    r = queries.QUERIES["op9_byte_bpe"](spark, "/root/testdata/sf0.001").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"doc_id = {r['doc_id']}").first()["text"]
    assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
