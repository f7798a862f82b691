"""Label vocabulary, weights and split queries on the derived tag table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import labels as L
from tessera.operators import splits as S
from tessera.plans import derived
from tessera.plans.registry import query
from tessera.plans.sqlparts import bucket
from tessera.sources.tables import table

_COUNTS = f"""WITH {derived.TAGS_SQL.strip()},
c AS (SELECT tag AS label, count(*)::BIGINT AS n FROM tags GROUP BY tag),
ty AS (SELECT DISTINCT substr(label, 3) AS t FROM c WHERE label <> 'O'),
u AS (SELECT 'B-' || t AS label FROM ty UNION SELECT 'I-' || t FROM ty UNION SELECT 'O'),
r AS (SELECT u.label, coalesce(c.n, p.n) AS n FROM u LEFT JOIN c ON u.label = c.label
      LEFT JOIN c p ON p.label = CASE WHEN u.label LIKE 'I-%' THEN 'B-' || substr(u.label, 3)
                                      WHEN u.label LIKE 'B-%' THEN 'I-' || substr(u.label, 3) END
      WHERE coalesce(c.n, p.n) IS NOT NULL)"""

_FOLD = "CASE WHEN tag = 'O' THEN 'O' WHEN tag LIKE 'B-%' THEN substr(tag, 3) END"


def _tag_rows(spark, sf):
    return derived.tag_rows(table(spark, sf, "documents"))


def _repaired(spark, sf):
    return L.repaired_counts(L.tag_counts(_tag_rows(spark, sf)))


@query("label_ids", sql=f"""{_COUNTS}
SELECT label, (row_number() OVER (ORDER BY n DESC, label) - 1)::INTEGER AS label_id FROM r""")
def q_label_ids(spark, sf):
    return L.label_ids(_repaired(spark, sf), by="frequency")


@query("label_ids_by_name", sql=f"""{_COUNTS}
SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS label_id FROM r""")
def q_label_ids_by_name(spark, sf):
    return L.label_ids(_repaired(spark, sf), by="name")


@query("tag_weights", sql=f"""{_COUNTS},
s AS (SELECT label, n, n + 1e-5::DOUBLE AS f FROM r),
w AS (SELECT label, n, ln((SELECT sum(f) FROM s) / f) AS w FROM s)
SELECT label, n, round(w / (SELECT max(w) FROM w), 6) AS weight FROM w""")
def q_tag_weights(spark, sf):
    w = L.log_weights(_repaired(spark, sf))
    return w.select("label", "n", F.round("weight", 6).alias("weight"))


@query("label_difference", sql=f"""{_COUNTS}
SELECT label FROM u EXCEPT SELECT label FROM c""")
def q_label_difference(spark, sf):
    counts = L.tag_counts(_tag_rows(spark, sf))
    return L.missing_labels(L.label_universe(counts), counts)


@query("tag_histogram", sql=f"""WITH {derived.TAGS_SQL.strip()}
SELECT {_FOLD} AS tag, count(*)::BIGINT AS n FROM tags WHERE {_FOLD} IS NOT NULL GROUP BY 1""")
def q_tag_histogram(spark, sf):
    return L.tag_histogram(_tag_rows(spark, sf))


_SPLIT3 = (f"CASE WHEN {bucket('doc_id')} < 700 THEN 'train' WHEN {bucket('doc_id')} < 850 THEN 'validation' "
           "ELSE 'test' END")


@query("tag_coverage", sql=f"""WITH {derived.TAGS_SQL.strip()},
f AS (SELECT {_SPLIT3} AS split, {_FOLD} AS tag FROM tags),
c AS (SELECT split, tag, count(*)::BIGINT AS n FROM f WHERE tag IS NOT NULL GROUP BY split, tag),
u AS (SELECT DISTINCT tag FROM f WHERE tag IS NOT NULL),
g AS (SELECT * FROM u, (VALUES ('train'), ('validation'), ('test')) s(split))
SELECT g.split, g.tag, coalesce(c.n, 0)::BIGINT AS n FROM g LEFT JOIN c ON g.split = c.split AND g.tag = c.tag""")
def q_tag_coverage(spark, sf):
    rows = S.bucket_split(_tag_rows(spark, sf), "doc_id")
    return L.tag_coverage(rows, "split", ["train", "validation", "test"])


@query("class_weights", sql="""
SELECT toxic, (SELECT count(*) FROM labels) / (2 * count(*)) AS weight FROM labels GROUP BY toxic""")
def q_class_weights(spark, sf):
    return L.class_weights(table(spark, sf, "labels"), "toxic")


@query("split_sequential", sql="""
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS ord, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN ord <= round_even(0.8::DOUBLE * n, 0) THEN 'train'
                    WHEN ord <= round_even(0.8::DOUBLE * n, 0) + round_even(round_even(0.2::DOUBLE * n, 0) / 2, 0)
                    THEN 'validation' ELSE 'test' END AS split FROM o""")
def q_split_sequential(spark, sf):
    return S.sequential_split(table(spark, sf, "documents").select("doc_id"), "doc_id").select("doc_id", "split")


_RATIO = f"""
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT, doc_id) AS ord,
                  count(*) OVER () AS n FROM documents),
s AS (SELECT doc_id, CASE WHEN ord <= floor(0.7::DOUBLE * n) THEN 'train'
                          WHEN ord <= floor(0.7::DOUBLE * n) + floor({(1 - 0.7) / 2!r}::DOUBLE * n) THEN 'validation'
                          ELSE 'test' END AS split FROM o)"""


def _ratio(spark, sf):
    return S.ratio_split(table(spark, sf, "documents").select("doc_id"), "doc_id", ratio=0.7)


@query("split_ratio", sql=f"{_RATIO} SELECT doc_id, split FROM s")
def q_split_ratio(spark, sf):
    return _ratio(spark, sf).select("doc_id", "split")


@query("split_sizes", sql=f"{_RATIO} SELECT split, count(*)::BIGINT AS n FROM s GROUP BY split")
def q_split_sizes(spark, sf):
    return S.split_sizes(_ratio(spark, sf))


@query("split_64_16_20", sql=f"""
SELECT doc_id, CASE WHEN {bucket('doc_id')} < 200 THEN 'test' WHEN {bucket('doc_id', seed=43)} < 200 THEN 'validation'
                    ELSE 'train' END AS split FROM documents""")
def q_split_64_16_20(spark, sf):
    return S.three_way_split(table(spark, sf, "documents").select("doc_id"), "doc_id").select("doc_id", "split")


@query("seeded_sample", sql="""
SELECT doc_id FROM documents WHERE lang = 'de'
ORDER BY ('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT, doc_id LIMIT 50""")
def q_seeded_sample(spark, sf):
    de = table(spark, sf, "documents").where(F.col("lang") == "de").select("doc_id")
    return S.seeded_sample(de, "doc_id", 50)


@query("first_n_per_class", sql="""
SELECT doc_id, toxic, rn FROM (
  SELECT d.doc_id, l.toxic, (row_number() OVER (PARTITION BY l.toxic ORDER BY d.doc_id))::INTEGER AS rn
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id) WHERE rn <= 20""")
def q_first_n_per_class(spark, sf):
    j = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    return S.first_n_per_class(j, "toxic", "doc_id", 20).select("doc_id", "toxic", "rn")


@query("first_n_distinct", sql="""
SELECT min(doc_id) AS doc_id, count(*)::BIGINT AS copies, md5(text) AS text_md5
FROM documents GROUP BY text ORDER BY min(doc_id) LIMIT 100""")
def q_first_n_distinct(spark, sf):
    d = S.first_n_distinct(table(spark, sf, "documents"), "text", "doc_id", 100)
    return d.select("doc_id", "copies", F.md5("text").alias("text_md5"))
