"""Span, alignment and sequence-metric queries on the derived tag table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.sequences import hash_bucket
from tessera.operators import labels as L
from tessera.operators import metrics as M
from tessera.operators import spans as SP
from tessera.plans import derived as D
from tessera.plans.labels import _COUNTS
from tessera.plans.registry import query
from tessera.sources.tables import table


def _rows(spark, sf):
    return D.tag_rows(table(spark, sf, "documents"))


@query("positive_runs", sql=f"""WITH {D.TAGS_SQL.strip()},
v AS (SELECT doc_id, pos, token FROM tags WHERE {D.value_sql()} > 0),
i AS (SELECT doc_id, pos, token, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS isl FROM v),
g AS (SELECT doc_id, min(pos) AS start, string_agg(token, ' ' ORDER BY pos) AS text FROM i GROUP BY doc_id, isl)
SELECT doc_id, start, text, regexp_replace(text, '\\s+', '', 'g') AS compact,
       len(string_split_regex(text, '\\s+'))::INTEGER AS n_tokens FROM g WHERE text <> ''""")
def q_positive_runs(spark, sf):
    # Row form: the per-token hash runs in a code-generated projection (inside
    # an array lambda it would be interpreted); one exchange by document.
    rows = D.token_rows(table(spark, sf, "documents")).withColumn("value", D.values(F.col("doc_id"), F.col("pos")))
    return SP.positive_runs(rows)


@query("bio_spans", sql=f"""WITH {D.TAGS_SQL.strip()},{D.spans_sql('tags', 'sp').rstrip()}
SELECT doc_id, start, "end", type, text FROM sp""")
def q_bio_spans(spark, sf):
    return SP.bio_spans_arrays(D.tagged_docs(table(spark, sf, "documents")))


@query("common_spans", sql=f"""WITH {D.TAGS_SQL.strip()},{D.spans_sql('tags', 'sp').rstrip()}
SELECT text AS span, count(*)::BIGINT AS n FROM sp GROUP BY text""")
def q_common_spans(spark, sf):
    s = SP.bio_spans_arrays(D.tagged_docs(table(spark, sf, "documents")))
    return s.groupBy(F.col("text").alias("span")).agg(F.count(F.lit(1)).alias("n"))


@query("listed_spans", sql=f"""WITH {D.TAGS_SQL.strip()},{D.spans_sql('tags', 'sp').rstrip()}
SELECT text AS span, count(*)::BIGINT AS n FROM sp GROUP BY text""")
def q_listed_spans(spark, sf):
    """Each document's span texts as a list literal in a string (quotes and backslashes escaped), counted."""
    d = D.tagged_docs(table(spark, sf, "documents"))
    s = SP.bio_spans_arrays(d).groupBy("doc_id").agg(F.collect_list("text").alias("spans"))
    escaped = lambda x: F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    literal = F.concat(F.lit("['"), F.array_join(F.transform("spans", escaped), "', '"), F.lit("']"))
    return SP.count_listed_spans(s.select(literal.alias("spans")), "spans")


@query("word_frequency", sql=f"""WITH {D.TAGS_SQL.strip()}
SELECT token, count(*)::BIGINT AS n FROM tk GROUP BY token ORDER BY n DESC, token""")
def q_word_frequency(spark, sf):
    return L.by_frequency(D.token_rows(table(spark, sf, "documents")), "token")


_PIECES_SQL = """
pc AS (SELECT doc_id, pos, token, tag, unnest(range(0, CAST(ceil(length(token) / 4) AS INTEGER))) AS k FROM tags),
pl AS (SELECT doc_id, pos, token,
              CASE WHEN (('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR) || ':' || CAST(k AS VARCHAR)), 1, 8))::BIGINT % 1000) % 3 = 0
                   THEN 'O' ELSE tag END AS label,
              (('0x' || substr(md5('7:' || CAST(doc_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR) || ':' || CAST(k AS VARCHAR)), 1, 8))::BIGINT % 1000) AS score
       FROM pc),
wl AS (SELECT doc_id, pos, min(token) AS token, max({'s': score, 'l': label}).l AS tag FROM pl GROUP BY doc_id, pos)"""


@query("scored_spans", sql=f"""WITH {D.TAGS_SQL.strip()},{_PIECES_SQL.rstrip()},{D.spans_sql('wl', 'sp').rstrip()}
SELECT doc_id, start, "end", type FROM sp""")
def q_scored_spans(spark, sf):
    rows = _rows(spark, sf)
    k = F.explode(F.sequence(F.lit(0), F.ceil(F.length("token") / 4).cast("int") - 1)).alias("k")
    pieces = rows.select("doc_id", "pos", "tag", k)
    pieces = pieces.select(
        "doc_id", "pos",
        # An O stays one whatever its hash.
        F.when((F.col("tag") != "O") & (hash_bucket("doc_id", "pos", "k") % 3 != 0), F.col("tag")).otherwise(F.lit("O")).alias("label"),
        hash_bucket("doc_id", "pos", "k", seed=7).alias("score"))
    words = SP.word_labels_from_pieces(pieces, word="pos")
    return SP.bio_spans(words, token=None)


@query("subtoken_labels", sql=f"""{_COUNTS},
ids AS (SELECT list(label ORDER BY n DESC, label) AS lab FROM r),
wt AS (SELECT doc_id, list(tag ORDER BY pos) AS tg, list(token ORDER BY pos) AS tk FROM tags GROUP BY doc_id),
wi AS (SELECT doc_id, tg, list_concat([NULL::INTEGER],
                 flatten(list_transform(tk, lambda w, i: list_transform(range(CAST(ceil(length(w) / 4) AS INTEGER)), lambda z: (i - 1)::INTEGER))),
                 [NULL::INTEGER]) AS w FROM wt),
lb AS (SELECT doc_id, w, list_transform(tg, lambda t: (list_position(ids.lab, t) - 1)::INTEGER) AS la FROM wi, ids)
SELECT doc_id, len(w)::INTEGER AS n_pieces,
       array_to_string(list_transform(w, lambda x: CASE WHEN x IS NULL THEN -100 ELSE la[x + 1] END), ' ') AS repeat_labels,
       array_to_string(list_transform(w, lambda x, j: CASE WHEN x IS NULL THEN -100 WHEN j > 1 AND w[j - 1] = x THEN -100
                                                          ELSE la[x + 1] END), ' ') AS first_labels
FROM lb""")
def q_subtoken_labels(spark, sf):
    docs = D.tagged_docs(table(spark, sf, "documents")).where(F.size("tokens") > 0)
    ids = L.label_ids(L.repaired_counts(L.tag_counts(_rows(spark, sf))))
    # The label vocabulary is one small row: broadcast it as a map.
    vocab = F.broadcast(ids.agg(F.map_from_entries(F.collect_list(F.struct("label", "label_id"))).alias("_m")))
    d = docs.crossJoin(vocab)
    pieces = F.transform("tokens", lambda w, i: F.array_repeat(i, F.ceil(F.length(w) / 4).cast("int")))
    null = F.array(F.lit(None).cast("int"))
    d = d.select("doc_id", F.concat(null, F.flatten(pieces), null).alias("wid"),
                 F.transform("tags", lambda t: F.element_at(F.col("_m"), t)).alias("lab"))
    as_text = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), " ")
    return d.select("doc_id", F.size("wid").alias("n_pieces"),
                    as_text(SP.subtoken_labels("wid", "lab", "repeat")).alias("repeat_labels"),
                    as_text(SP.subtoken_labels("wid", "lab", "first")).alias("first_labels"))


@query("sequence_metrics", sql=f"""WITH {D.TAGS_SQL.strip()},
ptags AS (SELECT doc_id, pos, token, {D.pred_tag_sql()} AS tag FROM tags),{D.spans_sql('tags', 'gs').rstrip()},{D.spans_sql('ptags', 'ps').rstrip()},
g AS (SELECT DISTINCT doc_id, start, "end", type FROM gs), p AS (SELECT DISTINCT doc_id, start, "end", type FROM ps),
c AS (SELECT g.* FROM g JOIN p ON g.doc_id = p.doc_id AND g.start = p.start AND g."end" = p."end" AND g.type = p.type),
u AS (SELECT type, 1 AS g, 0 AS p, 0 AS c FROM g UNION ALL SELECT type, 0, 1, 0 FROM p UNION ALL SELECT type, 0, 0, 1 FROM c),
a AS (SELECT CASE WHEN grouping(type) = 1 THEN 'overall' ELSE type END AS entity,
             sum(g)::BIGINT AS n_gold, sum(p)::BIGINT AS n_pred, sum(c)::BIGINT AS n_correct
      FROM u GROUP BY ROLLUP (type)),
m AS (SELECT *, coalesce(n_correct / nullif(n_pred, 0), 0) AS pr, coalesce(n_correct / nullif(n_gold, 0), 0) AS rc FROM a),
acc AS (SELECT avg(CASE WHEN t.tag = p.tag THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy
        FROM tags t JOIN ptags p ON t.doc_id = p.doc_id AND t.pos = p.pos)
SELECT entity, n_gold, n_pred, n_correct, round(pr, 6) AS precision, round(rc, 6) AS recall,
       round(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END, 6) AS f1, round(accuracy, 6) AS accuracy
FROM m, acc""")
def q_sequence_metrics(spark, sf):
    """Gold and predicted tags are compared inside a document's row; only sums are shuffled."""
    d = D.tagged_docs(table(spark, sf, "documents")).select("doc_id", "tags")
    d = d.withColumn("ptags", F.transform("tags", lambda t, i: D.pred_tag(t, F.col("doc_id"), i)))
    out = M.sequence_scores(d, "tags", "ptags")
    return out.select("entity", "n_gold", "n_pred", "n_correct",
                      *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "accuracy")])


@query("binary_metrics", sql="""
WITH lg AS (SELECT l.doc_id, l.toxic,
              [(('0x' || substr(md5('1:' || CAST(l.doc_id AS VARCHAR)), 1, 8))::BIGINT % 1000) / 1000.0,
               (('0x' || substr(md5('2:' || CAST(l.doc_id AS VARCHAR)), 1, 8))::BIGINT % 1000) / 1000.0 + 0.3 * l.toxic] AS lo
            FROM labels l),
p AS (SELECT toxic, (list_position(lo, list_max(lo)) - 1) AS pred FROM lg)
SELECT count(*)::BIGINT AS n, round(avg(CASE WHEN pred = toxic THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(coalesce(2.0 * sum(CASE WHEN pred = 1 AND toxic = 1 THEN 1 ELSE 0 END)
             / nullif(2 * sum(CASE WHEN pred = 1 AND toxic = 1 THEN 1 ELSE 0 END)
                      + sum(CASE WHEN pred = 1 AND toxic = 0 THEN 1 ELSE 0 END)
                      + sum(CASE WHEN pred = 0 AND toxic = 1 THEN 1 ELSE 0 END), 0), 0), 6) AS f1
FROM p""")
def q_binary_metrics(spark, sf):
    lab = table(spark, sf, "labels")
    logits = F.array((hash_bucket("doc_id", seed=1) / 1000.0),
                     (hash_bucket("doc_id", seed=2) / 1000.0) + F.lit(0.3) * F.col("toxic"))
    p = lab.select("toxic", M.argmax_first(logits).alias("pred"))
    s = M.binary_scores(p, "pred", "toxic")
    return s.select("n", F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))
