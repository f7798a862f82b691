"""Queries of the vector index: neighbours of a query set, and the index's recall."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import vector_index as VI
from tessera.operators import vectors as V
from tessera.plans.registry import query
from tessera.plans.sqlparts import bucket
from tessera.sources.tables import table

#: Length of the vectors, bits of a bucket, similarity and recall that the bands are made for, neighbours.
LENGTH, BITS, COSINE, RECALL, K = 64, 8, 0.3, 0.95, 5
BANDS = VI.bands_needed(COSINE, BITS, RECALL)

_INDEX = f"""
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS u FROM v),
planes AS (SELECT p, d, CASE WHEN {bucket("p || ':' || d", buckets=2)} = 0 THEN 1 ELSE -1 END AS s FROM range({BITS * BANDS}) a(p), range({LENGTH}) b(d)),
x AS (SELECT vec_id, generate_subscripts(e, 1) - 1 AS d, unnest(e) AS x FROM v),
sides AS (SELECT vec_id, p, sum(x * s) >= 0 AS above FROM x JOIN planes USING (d) GROUP BY vec_id, p),
codes AS MATERIALIZED (SELECT vec_id, p // {BITS} AS band, sum(CASE WHEN above THEN 1 << (p % {BITS})::INTEGER ELSE 0 END)::INTEGER AS code FROM sides GROUP BY ALL),
pairs AS (SELECT DISTINCT q.vec_id AS query_id, c.vec_id FROM codes q JOIN codes c USING (band)
          WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND bit_count(xor(q.code, c.code)) <= 1),
scored AS (SELECT query_id, p.vec_id, list_sum(list_transform(list_zip(a.u, b.u), lambda z: z[1] * z[2])) AS c
           FROM pairs p JOIN u a ON a.vec_id = p.query_id JOIN u b ON b.vec_id = p.vec_id),
found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS rank FROM scored) WHERE rank <= {K})"""


def _index(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", "embedding")
    queries = emb.where(F.col("vec_id") % 20 == 0).withColumnsRenamed({"vec_id": "query_id", "embedding": "query"})
    index = VI.build_index(emb, "vec_id", "embedding", LENGTH, bits=BITS, cosine=COSINE, recall=RECALL)
    return emb, queries, VI.neighbours(index, queries, "query_id", "query", k=K)


@query("cosine_index_topk", sql=f"""WITH {_INDEX.strip()}
SELECT query_id, rank::INTEGER AS rank, vec_id, round(c, 6) AS cosine FROM found""")
def q_cosine_index_topk(spark, sf):
    """The five nearest of every twentieth vector, from the index."""
    _, _, found = _index(spark, sf)
    return found.select("query_id", "rank", "vec_id", F.round("cosine", 6).alias("cosine"))


@query("cosine_index_recall", sql=f"""WITH {_INDEX.strip()},
every AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.u, b.u), lambda z: z[1] * z[2])) AS c
          FROM u a, u b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
exact AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY c DESC, vec_id) AS rank FROM every) WHERE rank <= {K})
SELECT count(*)::BIGINT AS n_exact, count(f.vec_id)::BIGINT AS n_found, round(count(f.vec_id) / count(*), 6) AS recall
FROM exact e LEFT JOIN found f ON e.query_id = f.query_id AND e.vec_id = f.vec_id""")
def q_cosine_index_recall(spark, sf):
    """The share of the exact neighbours that the index finds."""
    emb, queries, found = _index(spark, sf)
    exact = V.cosine_topk(emb, "vec_id", "embedding", queries, "query_id", "query", k=K + 1).where(F.col("query_id") != F.col("vec_id"))
    # Without the query's own row the ranks close up, wherever equal vectors put it.
    exact = V.top(exact, "query_id", "vec_id", K)
    r = VI.recall(found, exact, "query_id", "vec_id")
    return r.select("n_exact", "n_found", F.round("recall", 6).alias("recall"))
