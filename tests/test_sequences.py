import hashlib

from pyspark.sql import functions as F

from tessera.functions.sequences import hash_bucket, ngrams


def test_hash_bucket_matches_rule_h(spark):
    df = spark.range(20).select(F.col("id").alias("k"))
    got = dict((r["k"], r["b"]) for r in df.select("k", hash_bucket("k").alias("b")).collect())
    for k, b in got.items():
        assert b == int(hashlib.md5(f"42:{k}".encode()).hexdigest()[:8], 16) % 1000


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    out = [r[0] for r in df.select(ngrams(F.col("t"), 2)).collect()]
    assert out == [["a_b", "b_c"], [], []]
