import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import vocabulary as VO


@pytest.fixture(scope="module")
def words(spark):
    r = random.Random(1)
    texts = [(k, [r.choice(["the", "the", "the", "of", f"w{r.randrange(60)}"]) for _ in range(r.randrange(40))]) for k in range(120)]
    return texts, spark.createDataFrame([*texts, (1000, None)], "id int, t array<string>")


def test_ids_are_dense_and_ordered(spark, words):
    texts, df = words
    counts = VO.word_counts(df, "t")
    want = sorted(((-sum(t.count(w) for _, t in texts), w) for w in {w for _, t in texts for w in t}))
    got = {r["word"]: r["id"] for r in VO.vocabulary(counts).collect()}
    assert got == {w: k + VO.RESERVED for k, (_, w) in enumerate(want)}
    named = {r["word"]: r["id"] for r in VO.vocabulary(counts, by="name", reserved=0).collect()}
    assert named == {w: k for k, w in enumerate(sorted(got))}


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_round_trip(spark, words, hot):
    texts, df = words
    vocab = VO.vocabulary(VO.word_counts(df, "t"))
    ids = VO.encode(df, "id", "t", vocab, hot=hot)
    back = {r["id"]: r["words"] for r in VO.decode(ids, "id", "ids", vocab, hot=hot).collect()}
    assert back == {**dict(texts), 1000: []}


def test_unknown_words_and_padding(spark, words):
    vocab = VO.vocabulary(VO.word_counts(words[1], "t"))
    first = {r["word"]: r["id"] for r in vocab.collect()}["the"]
    df = spark.createDataFrame([(1, ["the", "never", "the"]), (2, [])], "id int, t array<string>")
    got = VO.encode(df, "id", "t", vocab).select("id", "ids", T.fixed_length("ids", 4, VO.PAD).alias("f"), T.attention_mask("ids", 4).alias("m"),
                                                 T.mask_pad(T.fixed_length("ids", 4, VO.PAD), F.size("ids")).alias("l"))
    rows = {r["id"]: r for r in got.collect()}
    assert rows[1]["ids"] == [first, VO.UNKNOWN, first] and rows[2]["ids"] == []
    assert rows[1]["f"] == [first, 1, first, 0] and rows[1]["m"] == [1, 1, 1, 0] and rows[1]["l"] == [first, 1, first, -100]
    assert rows[2]["f"] == [0] * 4 and rows[2]["l"] == [-100] * 4
    assert VO.decode(VO.encode(df, "id", "t", vocab), "id", "ids", vocab).where("id = 1").first()["words"] == ["the", None, "the"]


def test_no_hot_word_meets_in_one_task(spark):
    """Half of all tokens are one word: no partition of the join by word gets more than its share."""
    df = spark.range(2000).select(F.col("id").cast("int"), F.array(F.lit("the"), F.concat(F.lit("w"), (F.col("id") % 500).cast("string"))).alias("t"))
    vocab = VO.vocabulary(VO.word_counts(df, "t"))
    plan = VO.encode(df, "id", "t", vocab, hot=1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2 and "BroadcastExchange" in plan


def test_known_words_are_no_rows(spark, words):
    """Words of the resolved table stay in their text's array, null words and repeated keys included."""
    df = spark.createDataFrame([(1, ["a", None, "b"]), (1, ["c"]), (2, None)], "id int, t array<string>")
    vocab = VO.vocabulary(VO.word_counts(words[1], "t").unionByName(spark.createDataFrame([("a", 1), ("b", 1)], "word string, n long")))
    ids = {r["word"]: r["id"] for r in vocab.collect()}
    for hot in (0, 1000):
        encoded = VO.encode(df, "id", "t", vocab, hot=hot)
        assert "posexplode" not in encoded._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: r["ids"] for r in encoded.collect()}
        assert got == {1: [*sorted([ids["a"], VO.UNKNOWN]), VO.UNKNOWN, ids["b"]], 2: []}
