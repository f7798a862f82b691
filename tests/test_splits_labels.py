from pyspark.sql import functions as F

from tessera.operators import labels as L
from tessera.operators import splits as S


def test_ordinal_is_exact(spark):
    df = spark.range(0, 5000, 7).select((F.col("id") * 3 % 10007).alias("k"))
    o = S.ordinal(df, "k")
    got = sorted((r["k"], r["ordinal"]) for r in o.collect())
    assert [x[1] for x in got] == list(range(1, len(got) + 1))


def test_sequential_and_ratio_split_sizes(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"))
    seq = dict(S.split_sizes(S.sequential_split(df, "doc_id")).collect())
    assert seq == {"train": 800, "validation": 100, "test": 100}
    rat = S.ratio_split(df, "doc_id", ratio=0.7)
    sizes = dict(S.split_sizes(rat).collect())
    assert sizes == {"train": 700, "validation": 150, "test": 150}
    assert rat.select("doc_id").distinct().count() == 1000


def test_three_way_split_disjoint(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"))
    out = S.three_way_split(df, "doc_id")
    assert out.count() == 2000 and out.select("split").distinct().count() == 3


def test_first_n_per_class_and_sample(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id int, label int")
    got = S.first_n_per_class(df, "label", "doc_id", 3)
    assert sorted(r["doc_id"] for r in got.collect()) == [0, 1, 2, 3, 4, 5]
    assert S.seeded_sample(df, "doc_id", 5).count() == 5


def test_repaired_counts_and_weights(spark):
    rows = spark.createDataFrame([("O",), ("O",), ("B-X",), ("I-X",), ("B-Y",)], "tag string")
    rep = dict(L.repaired_counts(L.tag_counts(rows)).collect())
    assert rep == {"O": 2, "B-X": 1, "I-X": 1, "B-Y": 1, "I-Y": 1}
    w = {r["label"]: r["weight"] for r in L.log_weights(L.repaired_counts(L.tag_counts(rows))).collect()}
    assert abs(max(w.values()) - 1.0) < 1e-12 and w["O"] < w["B-X"]
    ids = dict(L.label_ids(L.repaired_counts(L.tag_counts(rows))).collect())
    assert ids["O"] == 0 and sorted(ids.values()) == list(range(5))


def test_histogram_and_coverage(spark):
    rows = spark.createDataFrame([("a", "O"), ("a", "B-X"), ("a", "I-X"), ("b", "B-Y")], "split string, tag string")
    h = dict(L.tag_histogram(rows).collect())
    assert h == {"O": 1, "X": 1, "Y": 1}
    cov = {(r["split"], r["tag"]): r["n"] for r in L.tag_coverage(rows, "split", ["a", "b"]).collect()}
    assert cov[("b", "X")] == 0 and cov[("a", "X")] == 1 and len(cov) == 6


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    w = dict(L.class_weights(df, "y").collect())
    assert w == {0: 4 / 6, 1: 2.0}


def test_an_outlier_does_not_fill_a_partition(spark):
    df = spark.range(10_000).unionByName(spark.range(10**12, 10**12 + 1)).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        o = S.ordinal(df, "k")
        placed = df.repartitionByRange("k").groupBy(F.spark_partition_id().alias("p")).count()
        sizes = [r["count"] for r in placed.collect()]
        assert max(sizes) < 5_000 and sum(sizes) == 10_001
        assert o.where("ordinal <> k + 1 AND k < 10000 OR k >= 10000 AND ordinal <> 10001").isEmpty()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _hashes(keys, seed=42):
    import hashlib

    return [int(hashlib.md5(f"{seed}:{k}".encode()).hexdigest()[:8], 16) for k in keys]


def test_ratio_split_is_the_sorted_cut(spark):
    keys = [k * 7919 for k in range(3001)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    for ratio in (0.7, 0.0, 1.0, 0.33):
        got = {r["k"]: r["split"] for r in S.ratio_split(df, "k", ratio).collect()}
        train, validation = int(ratio * len(keys)), int((1 - ratio) / 2 * len(keys))
        order = [k for _, k in sorted(zip(_hashes(keys), keys))]
        want = {k: "train" if n < train else "validation" if n < train + validation else "test" for n, k in enumerate(order)}
        assert got == want


def test_ratio_split_with_repeated_keys_is_exact(spark):
    """A key with most of the rows is cut in the middle; the sizes stay exact."""
    df = spark.createDataFrame([(1 if k % 4 else k + 2, k) for k in range(1000)] + [(None, k) for k in range(100)], "k long, v long").repartition(6)
    split = S.ratio_split(df, "k", 0.5)
    assert dict(S.split_sizes(split).collect()) == {"train": 550, "validation": 275, "test": 275}
    assert split.select("v").count() == 1100 and split.columns == ["k", "v", "split"]


def test_ratio_split_of_an_empty_table(spark):
    assert S.ratio_split(spark.createDataFrame([], "k long"), "k").collect() == []


def test_ratio_split_sorts_no_rows(spark):
    plan = S.ratio_split(spark.range(1000).withColumnRenamed("id", "k"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_selection_against_sorting(spark):
    import random

    r = random.Random(2)
    values = [r.randrange(1 << 32) for _ in range(500)] + [7] * 50 + [(1 << 32) - 1] * 3 + [0]
    df = spark.createDataFrame([(v,) for v in values], "h long").repartition(3)
    ranks = [1, 2, 30, 52, 53, 300, len(values)]
    n, found = S.select_ranks(df, "h", lambda n: ranks)
    order = sorted(values)
    assert n == len(values)
    assert [f[0] for f in found] == [order[k - 1] for k in ranks]
    assert [(b, s) for _, b, s in found] == [(order.index(order[k - 1]), order.count(order[k - 1])) for k in ranks]


def test_a_repeated_key_spreads_over_partitions(spark):
    df = spark.range(8000).select((F.col("id") % 4 == 0).cast("int").alias("k"), "id").withColumn("k", F.when(F.col("k") == 0, F.lit(5)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        o = S.ordinal(df, "k")
        assert sorted(r["ordinal"] for r in o.select("ordinal").collect()) == list(range(1, 8001))
        assert o.where("k IS NULL").agg(F.max("ordinal")).first()[0] == 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
