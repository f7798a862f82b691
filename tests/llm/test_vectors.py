"""Operators 11, 12 and 13 against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import collision_search, lookup_clusters, metric_trees

ROWS = "vec_id long, embedding array<double>, label int, text string, key string, v int"


def table_of(spark, rows, partitions=3):
    """Rows (vec_id, vector, label) with extra columns, two of them named like the operators' own."""
    return spark.createDataFrame([(i, v, lab, "t", "k", 1) for i, v, lab in rows], ROWS).repartition(partitions, F.rand(1))


def odd(length):
    inf, nan = float("inf"), float("nan")
    return [(9001, None, 1), (9002, [], 1), (9003, [1.0] * (length - 1) + [None], 1), (9004, [nan] + [1.0] * (length - 1), 1),
            (9005, [1.0] * (length - 1) + [-inf], 2), (9006, [1.0] * (length + 1), 1)]


def brute_clusters(rows, length, scale, k, rounds, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, _ in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]
    measure = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for n in range(rounds + 1):
        found = [min((measure(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        if n < rounds:
            for j in range(len(centres)):
                own = [v for (_, v), (_, c) in zip(kept, found) if c == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own)]
    inertia = sum(d for d, _ in found)
    return sorted(((i if i is not None else -1, c, d, sum(e for e, o in found if o == c), inertia, centres[c]) for (i, _), (d, c) in zip(kept, found)), key=str)


def clustered(spark, rows, **of):
    got = lookup_clusters.cluster(table_of(spark, rows, of.pop("partitions", 3)), **of)
    return sorted(((r["vec_id"] if r["vec_id"] is not None else -1, r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid"]) for r in got.collect()), key=str)


def test_op11_is_exact_on_ties_copies_and_odd_rows(spark):
    r = random.Random(1)
    rows = [(i, [r.choice([-0.51, -0.25, 0.0, 0.1, 0.26]) for _ in range(4)], 0) for i in range(120)]
    rows += [(500 + i, rows[3][1], 1) for i in range(80)] + [(7, [0.3] * 4, 1), (7, [0.2] * 4, 1), (None, [0.9] * 4, 1), *odd(4)]
    of = dict(length=4, scale=64, k=6, rounds=3, seed=1)
    want = brute_clusters(rows, **of)
    assert clustered(spark, rows, **of) == want == clustered(spark, rows, partitions=1, **of)
    few = rows[:2] + rows[-9:-6] + odd(4)
    assert clustered(spark, few, **of) == brute_clusters(few, **of)
    assert clustered(spark, odd(4), **of) == [] == clustered(spark, [], **of)


def test_op11_empty_clusters_stay_and_large_values_are_bounded(spark):
    rows = [(i, [0.5, 0.5], 0) for i in range(5)] + [(9, [1e300, -1e300], 0)]
    of = dict(length=2, scale=64, k=4, rounds=2, seed=1)
    found = clustered(spark, rows, **of)
    assert len({r[1] for r in found}) == 2 and found[-1][5] == [1 << 27, -(1 << 27)]  # of equal centroids the first takes all


def test_op11_tables_are_renewed_when_full(monkeypatch):
    monkeypatch.setattr(lookup_clusters, "MOST", 8)
    x = np.random.default_rng(2).integers(-1000, 1000, (400, 3))
    centres = x[:5].copy()
    tables = lookup_clusters.Tables(centres)
    for part in np.array_split(x, 20):
        assert (tables.distances(part) == ((part[:, None] - centres) ** 2).sum(2)).all()
        assert max(map(len, tables.values)) <= 8 + 2 * len(part)
    assert tables.distances(x[:0]).shape == (0, 5)


def brute_codes(rows, length, scale, parts, size, rounds):
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = length // parts
    measure = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books, codes, errors = [], [""] * len(kept), [0] * len(kept)
    for p in range(parts):
        cut = [v[p * width : (p + 1) * width] for _, v, _ in kept]
        book = cut[:size]
        for n in range(rounds + 1):
            found = [min((measure(v, e), j) for j, e in enumerate(book)) for v in cut]
            if n < rounds:
                book = [([sum(x) // len(own) for x in zip(*own)] if (own := [v for v, (_, c) in zip(cut, found) if c == j]) else e) for j, e in enumerate(book)]
        books.append(book)
        for k, (d, c) in enumerate(found):
            codes[k] += f"{c:02x}"
            errors[k] += d
    by = {}
    for (_, _, lab), e in zip(kept, errors):
        by[lab] = by.get(lab, 0) + e
    return sorted((str(i), str(lab), c, e, by[lab]) for (i, _, lab), c, e in zip(kept, codes, errors)), books


def compressed(spark, rows, partitions=3, **of):
    codes, books = metric_trees.compress(table_of(spark, rows, partitions), **of)
    got = metric_trees.label_errors(codes).collect()
    return sorted((str(r["vec_id"]), str(r["label"]), r["code"], r["error"], r["label_error"]) for r in got), books.tolist()


def test_op12_is_exact_on_ties_copies_and_odd_rows(spark):
    r = random.Random(3)
    rows = [(i, [r.randrange(-4, 5) / 4 for _ in range(8)], r.choice([1, 2, None])) for i in range(400)]
    rows += [(1000 + i, rows[5][1], 2) for i in range(200)] + [(3, [0.75] * 8, 1), (None, [0.5] * 8, None), *odd(8), (8000, [1.0] * 6, 3)]
    of = dict(scale=1024, parts=4, size=20, rounds=4)
    want = brute_codes(rows, 8, **of)
    assert compressed(spark, rows, **of) == want == compressed(spark, rows, 1, **of)
    few = rows[:3] + odd(8)[:5]
    assert compressed(spark, few, **of) == brute_codes(few, 8, **of)
    for none in ([], odd(8)[:3], [(1, [1.0] * 6, 3)]):
        assert compressed(spark, none, **of)[0] == []


def test_op12_trees_hold_their_balls_and_prune():
    r = np.random.default_rng(5)
    centres = r.integers(-10000, 10000, (20, 16))
    points = centres[r.integers(0, 20, 3000)] + r.integers(-30, 30, (3000, 16))
    tree = metric_trees.Tree.build(points)
    assert (np.sort(tree.order) == np.arange(3000)).all() and (tree.points == points[tree.order]).all()
    for (s, e, left, right), total, centre, wide in zip(tree.balls, tree.total, tree.centre, tree.wide):
        assert (tree.points[s:e].sum(0) == total).all() and ((tree.points[s:e] - centre) ** 2).sum(1).max() == wide
        if left >= 0:
            assert tree.balls[left][0] == s and tree.balls[left][1] == tree.balls[right][0] and tree.balls[right][1] == e
        else:
            assert e - s <= metric_trees.LEAF or wide <= 16
    entries = np.concatenate([centres + 1, centres + 1, points[:200]])
    owned = []
    taken = tree.owners(entries, lambda ball, entry: owned.append(ball), lambda ball, left: None)
    assert owned and taken < 3000 * 220 / 4
    again = metric_trees.Tree.read(tree.packed(), 16)
    far = ((points[:, None] - entries) ** 2).sum(2)
    code, error = again.codes(entries)
    assert (code == far.argmin(1)).all() and (error == far.min(1)).all()


def nearest(rows, k):
    usable = [(0, i, np.array(v)) for i, v, _ in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    x = np.stack([v / np.abs(v).max() if np.abs(v).max() < 1e-100 else v for _, _, v in usable])
    norm = np.sqrt((x**2).sum(1))
    found = {}
    for n, (_, i, _) in enumerate(usable):
        if i is not None and i % 50 == 0:
            score = (x * x[n]).sum(1) / (norm * norm[n])
            order = sorted((m for m in range(len(usable)) if m != n), key=lambda m: (-score[m], usable[m][1] is None, usable[m][1] or 0))
            found.setdefault(i, []).append([(usable[m][1], score[m]) for m in order[:k]])
    return found


@pytest.fixture(scope="module")
def cloud():
    r = np.random.default_rng(7)
    centres = r.standard_normal((8, 64))
    x = r.standard_normal((1500, 64)) + centres[r.integers(0, 8, 1500)]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(2000 + i, rows[100][1], 0) for i in range(300)]  # a very common vector, of a query
    rows += [(3000 + i, (x[150] + 0.01 * r.standard_normal(64)).tolist(), 0) for i in range(40)]
    return rows + [(50, x[3].tolist(), 0), (None, x[200].tolist(), 0), (8000, [0.0] * 64, 0), (8050, (x[4] * 1e-170).tolist(), 0), *odd(64)]


def test_op13_recall_scores_and_ties(spark, cloud):
    want = nearest(cloud, 5)
    got = collision_search.search(table_of(spark, cloud), asks=F.col("vec_id") % 50 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(want) and 8050 in by and 8000 not in by
    assert len(by[50]) == 10 and all([r["rank"] for r in v] == [1, 2, 3, 4, 5] for q, v in by.items() if q != 50)
    assert [r["vec_id"] for r in by[100]] == [2000, 2001, 2002, 2003, 2004] and all(abs(r["score"] - 1) < 1e-12 for r in by[100])
    hits = sum(len({r["vec_id"] for r in by[q]} & {i for i, _ in w[0]}) for q, w in want.items() if q != 50)
    assert hits >= 0.95 * 5 * (len(want) - 1)
    exact = {(q, i): s for q, w in want.items() for found in w for i, s in found}
    assert all(abs(exact[q, r["vec_id"]] - r["score"]) < 1e-12 for q, v in by.items() if q != 50 for r in v if (q, r["vec_id"]) in exact)


def test_op13_does_not_depend_on_the_partitions(spark, cloud):
    rows = [c for c in cloud if c[0] != 50 or c is cloud[50]]  # unique keys
    run = lambda n: sorted(map(tuple, collision_search.search(table_of(spark, rows, n), asks=F.col("vec_id") % 50 == 0).collect()))
    one = run(1)
    assert one == run(7)


def test_op13_few_rows(spark):
    e = [[1.0] + [0.0] * 3, [0.0, 1.0, 0.0, 0.0], [-1.0, 0.0, 0.0, 0.0]]
    rows = [(50 * i, v, 0) for i, v in enumerate(e)]
    got = sorted(tuple(r) for r in collision_search.search(table_of(spark, rows), asks=F.col("vec_id") % 50 == 0).collect())
    assert got == [(0, 1, 50, 0.0), (0, 2, 100, -1.0), (50, 1, 0, 0.0), (50, 2, 100, 0.0), (100, 1, 50, 0.0), (100, 2, 0, -1.0)]
    assert collision_search.search(table_of(spark, rows[:1])).collect() == []
    assert collision_search.search(table_of(spark, [])).collect() == [] == collision_search.search(table_of(spark, odd(4)[:3])).collect()


def test_op13_threshold():
    r = np.random.default_rng(3)
    hits = (np.abs(r.standard_normal((20000, collision_search.LINES))) <= collision_search.REACH).sum(1) >= collision_search.COLLISIONS
    assert collision_search.SURE - 0.005 < hits.mean() < 1


def test_vectors_of_arrow_batches():
    import pyarrow as pa

    from tessera.llm.dense import vectors

    column = pa.array([[9.0, 9.0], [1.0, 2.0], None, [1.0, None], [3.0], [4.0, 5.0]], pa.list_(pa.float32())).slice(1)
    rows, x = vectors(column, 2)
    assert rows.tolist() == [0, 4] and x.tolist() == [[1, 2], [4, 5]]
    assert vectors(column.slice(0, 0), 2)[1].shape == (0, 2)


def test_types_are_the_contracts(spark):
    import __spark_entry__ as entry

    got = {name: entry.queries()[name](spark, "/root/testdata/sf0.001").dtypes for name in ("op11_lookup_clusters", "op12_metric_trees", "op13_collision_search")}
    assert got["op11_lookup_clusters"] == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string")]
    assert got["op12_metric_trees"] == [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")]
    assert got["op13_collision_search"] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
