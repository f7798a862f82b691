import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import vector_index as VI
from tessera.operators import vectors as V


@pytest.fixture(scope="module")
def cloud(spark):
    r = np.random.default_rng(3)
    centres = r.standard_normal((12, 16))
    x = centres[r.integers(0, 12, 900)] + 0.6 * r.standard_normal((900, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(1000 + k, x[40].tolist()) for k in range(200)]  # copies of a query's vector
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [1.0] * 15), (2003, [None] + [1.0] * 15)]
    return spark.createDataFrame(rows, "id int, v array<double>").repartition(4)


def test_bands_needed():
    assert VI.bands_needed(1.0 - 1e-12, 8, 0.9) <= 2 < VI.bands_needed(0.5, 8, 0.9) < VI.bands_needed(0.2, 8, 0.9)


def test_recall_and_ties(spark, cloud):
    queries = cloud.where(F.col("id") % 20 == 0).select(F.col("id").alias("q"), F.col("v").alias("qv"))
    index = VI.build_index(cloud, "id", "v", 16, bits=6, cosine=0.7, recall=0.97)
    found = VI.neighbours(index, queries, "q", "qv", k=5)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["q"], r["rank"])):
        got.setdefault(r["q"], []).append((r["id"], r["cosine"]))
    assert [i for i, _ in got[40]] == [1000, 1001, 1002, 1003, 1004] and all(abs(c - 1) < 1e-12 for _, c in got[40])
    assert not {2000, 2001, 2002, 2003} & set(got)
    usable = cloud.where("id < 2000")
    exact = V.cosine_topk(usable, "id", "v", queries.where("q < 2000"), "q", "qv", k=6).where("q <> id")
    share = VI.recall(found, V.top(exact, "q", "id", 5), "q", "id").first()
    assert share["recall"] >= 0.95 and share["n_exact"] == 5 * len(got)


def test_no_query_meets_all_vectors(spark, cloud):
    queries = cloud.where(F.col("id") % 20 == 0).select(F.col("id").alias("q"), F.col("v").alias("qv"))
    index = VI.build_index(cloud, "id", "v", 16, bits=6, bands=4)
    plan = VI.neighbours(index, queries, "q", "qv")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    pairs, _ = VI.candidates(index, queries, "q", "qv")
    assert 0 < pairs.count() < 0.8 * index.rows.count() * queries.where("q < 2000").count()


def test_copies_of_a_vector_are_bounded(spark, cloud):
    index = VI.build_index(cloud, "id", "v", 16, bits=6, bands=4, copies=6)
    assert index.rows.count() == 900 - 1 + 6
    with pytest.raises(ValueError):
        VI.neighbours(index, cloud.select(F.col("id").alias("q"), F.col("v").alias("qv")), "q", "qv", k=6)


def test_pairs_are_not_joined_with_vectors(spark, cloud):
    """Blocks of buckets meet once; neither pairs nor all scores of a query are rows of a shuffle or a sort."""
    queries = cloud.where(F.col("id") % 20 == 0).select(F.col("id").alias("q"), F.col("v").alias("qv"))
    plan = VI.neighbours(VI.build_index(cloud, "id", "v", 16, bits=6, bands=4), queries, "q", "qv")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "MapInArrow" in plan


def test_exact_search_keeps_nulls_and_ties(spark):
    """Vectors that are null, zero or of another length have a null cosine and come last; ties go by key."""
    rows = [(9, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 2.0]), (1, None), (2, [0.0, 0.0]), (5, [1.0]), (6, [None, 1.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>").repartition(3)
    asked = spark.createDataFrame([("a", [2.0, 0.0]), ("b", None)], "q string, qv array<double>")
    got = {}
    for r in sorted(V.cosine_topk(df, "id", "v", asked, "q", "qv", k=6).collect(), key=lambda r: (r["q"], r["rank"])):
        got.setdefault(r["q"], []).append((r["id"], r["cosine"]))
    assert got == {"a": [(3, 1.0), (9, 1.0), (4, 0.0), (1, None), (2, None), (5, None)], "b": [(k, None) for k in (1, 2, 3, 4, 5, 6)]}


def test_blocks_are_not_broadcast(spark, cloud):
    """Queries have a copy for each bucket in which they look: the planner's estimate, of one each, would send all through the driver."""
    queries = cloud.where(F.col("id") % 20 == 0).select(F.col("id").alias("q"), F.col("v").alias("qv"))
    index = VI.build_index(cloud, "id", "v", 16, bits=6, bands=4)
    plan = VI.neighbours(index, queries, "q", "qv")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_many_small_blocks_give_the_same_neighbours(spark, cloud, monkeypatch):
    queries = cloud.where(F.col("id") % 20 == 0).select(F.col("id").alias("q"), F.col("v").alias("qv"))
    index = VI.build_index(cloud, "id", "v", 16, bits=6, cosine=0.7, recall=0.97)
    want = sorted(map(tuple, VI.neighbours(index, queries, "q", "qv").collect()))
    for name, n in (("RUN", 70), ("LEAST_RUN", 10), ("_BATCH", 8)):
        monkeypatch.setattr(VI, name, n)
    assert sorted(map(tuple, VI.neighbours(index, queries, "q", "qv").collect())) == want


def test_best_of_what_a_task_found():
    """Ties with the last one stay, a pair found twice counts once, NaN comes first and null last."""
    rows = [("a", 0, "x", 7, 0.5), ("a", 0, "x", 7, 0.5), ("a", 0, "y", 8, 0.25), ("a", 0, "z", 9, 0.25), ("a", 0, "w", 6, 0.1), ("a", 0, "n", 5, None),
            ("b", 1, "x", 7, float("nan")), ("b", 1, "y", 8, 0.9), ("b", 1, "z", 9, 0.8), ("c", 2, "n", 5, None)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["q", "_q", "key", "_c", "cosine"])
    left = V._left([batch.slice(0, 3), batch.slice(3)], 2).to_pydict()
    assert sorted(zip(left["q"], left["key"])) == [("a", "x"), ("a", "y"), ("a", "z"), ("b", "x"), ("b", "y"), ("c", "n")]
