"""Lookup, set, report and phrase queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.sequences import hash_bucket
from tessera.functions.text import clean_string, tokens
from tessera.operators import lookup as LK
from tessera.plans import derived as D
from tessera.plans.registry import query
from tessera.plans.sqlparts import toks
from tessera.session import scratch_path
from tessera.sources.tables import table

_LANG_VALUES = ", ".join(f"('{c}', '{a}', '{n}')" for c, a, n, _ in LK.LANGUAGES)


@query("lang_lookup", sql=f"""
SELECT d.doc_id, d.lang, t.alpha3, t.lang_name FROM documents d
LEFT JOIN (VALUES {_LANG_VALUES}) t(code, alpha3, lang_name) ON d.lang = t.code""")
def q_lang_lookup(spark, sf):
    """The language table is read from a JSON file."""
    path = scratch_path(spark, "languages")
    LK.write_language_json(LK.language_table(spark), path)
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return LK.lookup_language(d, "lang", LK.read_language_json(spark, path)).select("doc_id", "lang", "alpha3", "lang_name")


@query("lang_profile", sql=f"""
WITH t AS (SELECT doc_id, lang, unnest({toks('text')}) AS word FROM documents),
c AS (SELECT lang, word, count(*) AS n FROM t GROUP BY lang, word),
p AS (SELECT lang, word FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM c) WHERE r <= 50),
h AS (SELECT t.doc_id, p.lang, count(*) AS hits FROM t JOIN p ON t.word = p.word GROUP BY t.doc_id, p.lang),
b AS (SELECT doc_id, min({{'nh': -hits, 'l': lang}}) AS b FROM h GROUP BY doc_id)
SELECT d.doc_id, b.b.l AS lang_pred, coalesce(-b.b.nh, 0)::BIGINT AS hits FROM documents d LEFT JOIN b ON d.doc_id = b.doc_id""")
def q_lang_profile(spark, sf):
    docs = table(spark, sf, "documents")
    return LK.detect_language(docs, LK.language_profiles(docs, k=50))


_TERMS = f"""
bt AS (SELECT DISTINCT unnest({toks('text')}) AS term FROM benchmark),
dt AS (SELECT DISTINCT unnest({toks('text')}) AS term FROM documents)"""


def _terms(spark, sf, name):
    return table(spark, sf, name).select(F.explode(F.array_distinct(tokens("text"))).alias("term")).distinct()


@query("terms_intersect", sql=f"WITH {_TERMS.strip()} SELECT term FROM bt INTERSECT SELECT term FROM dt")
def q_terms_intersect(spark, sf):
    return _terms(spark, sf, "benchmark").intersect(_terms(spark, sf, "documents"))


@query("terms_missing", sql=f"WITH {_TERMS.strip()} SELECT term FROM bt WHERE term NOT IN (SELECT term FROM dt)")
def q_terms_missing(spark, sf):
    b = _terms(spark, sf, "benchmark").distinct()
    return b.join(_terms(spark, sf, "documents"), "term", "left_anti")


@query("dup_report", sql="""
SELECT count(*)::BIGINT AS n_rows, count(DISTINCT text)::BIGINT AS n_distinct,
       (count(*) - count(DISTINCT text))::BIGINT AS n_duplicates FROM documents""")
def q_dup_report(spark, sf):
    return LK.duplicate_report(table(spark, sf, "documents"), "text")


@query("correction_report", sql="""
WITH l AS (SELECT trim(unnest(string_split(text, chr(10)))) AS line FROM documents),
r AS (SELECT line, CASE WHEN line = '' THEN NULL ELSE trim(regexp_replace(line, '\\s+', ' ', 'g')) END AS resp FROM l),
u AS (SELECT DISTINCT line, resp FROM r)
SELECT (SELECT count(DISTINCT line) FROM r)::BIGINT AS n_asked,
       ((SELECT count(*) FROM r) - (SELECT count(DISTINCT line) FROM r))::BIGINT AS n_duplicates,
       sum(CASE WHEN resp = line THEN 1 ELSE 0 END)::BIGINT AS n_clean,
       sum(CASE WHEN resp IS NOT NULL AND resp <> line THEN 1 ELSE 0 END)::BIGINT AS n_corrected,
       sum(CASE WHEN resp IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_skipped FROM u""")
def q_correction_report(spark, sf):
    """Inputs are document lines (stripped); the response column is the
    whitespace-normalised line, missing for empty lines."""
    lines = (table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("raw"))
             .select(F.trim("raw").alias("line")))
    resp = F.when(F.col("line") == "", F.lit(None)).otherwise(clean_string("line"))
    return LK.correction_report(lines.withColumn("resp", resp), "line", "resp").select(
        *[F.col(c).cast("bigint").alias(c) for c in ("n_asked", "n_duplicates", "n_clean", "n_corrected", "n_skipped")])


@query("correction_rows", sql="""
WITH l AS (SELECT trim(unnest(string_split(text, chr(10)))) AS line FROM documents),
r AS (SELECT line, CASE WHEN line = '' THEN NULL ELSE trim(regexp_replace(line, '\\s+', ' ', 'g')) END AS resp FROM l)
SELECT DISTINCT line, resp, CASE WHEN resp IS NULL THEN 'skipped' WHEN resp = line THEN 'clean' ELSE 'corrected' END AS outcome FROM r""")
def q_correction_rows(spark, sf):
    lines = (table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("raw"))
             .select(F.trim("raw").alias("line")))
    return LK.correction_rows(lines.withColumn("resp", F.when(F.col("line") != "", clean_string("line"))), "line", "resp")


def _edges(spark, sf, dealt: bool = False):
    """A derived dependency edge table: each token's head is the previous token;
    the first token is ``ROOT``; a rule-H third of the rest are ``nmod``.
    ``dealt``: by sentence, for what gathers sentences; an exchange of texts, not of edges."""
    docs = table(spark, sf, "documents")
    rows = D.token_rows(docs.select("doc_id", "text").repartition("doc_id") if dealt else docs)
    dep = (F.when(F.col("pos") == 0, F.lit("ROOT"))
           .when(hash_bucket("doc_id", "pos") % 3 == 0, F.lit("nmod")).otherwise(F.lit("amod")))
    return rows.select(F.col("doc_id").alias("sent_id"), F.col("pos").alias("i"), F.col("token").alias("text"),
                       dep.alias("dep"), F.when(F.col("pos") > 0, F.col("pos") - 1).alias("head_i"))


_EDGES_SQL = f"""{D.TAGS_SQL.strip()},
e AS (SELECT doc_id AS sent_id, pos AS i, token AS text,
             CASE WHEN pos = 0 THEN 'ROOT'
                  WHEN (('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR)), 1, 8))::BIGINT % 1000) % 3 = 0 THEN 'nmod'
                  ELSE 'amod' END AS dep,
             CASE WHEN pos > 0 THEN pos - 1 END AS head_i FROM tk)"""


@query("dependency_phrase", sql=f"""WITH {_EDGES_SQL},
k AS (SELECT sent_id, i AS node FROM e WHERE contains(text, 'tion')),
g1 AS (SELECT c.sent_id, c.i AS node FROM k JOIN e c ON c.sent_id = k.sent_id AND c.head_i = k.node WHERE c.dep = 'nmod'),
g2 AS (SELECT c.sent_id, c.i AS node FROM g1 JOIN e c ON c.sent_id = g1.sent_id AND c.head_i = g1.node),
g3 AS (SELECT c.sent_id, c.i AS node FROM g2 JOIN e c ON c.sent_id = g2.sent_id AND c.head_i = g2.node),
g4 AS (SELECT c.sent_id, c.i AS node FROM g3 JOIN e c ON c.sent_id = g3.sent_id AND c.head_i = g3.node),
m AS (SELECT * FROM k UNION SELECT * FROM g1 UNION SELECT * FROM g2 UNION SELECT * FROM g3 UNION SELECT * FROM g4)
SELECT m.sent_id, string_agg(e.text, ' ' ORDER BY m.node) AS phrase
FROM m JOIN e ON m.sent_id = e.sent_id AND m.node = e.i GROUP BY m.sent_id""")
def q_dependency_phrase(spark, sf):
    return LK.dependency_phrase(_edges(spark, sf, dealt=True), "tion")


@query("phrase_root", sql=f"""WITH {_EDGES_SQL}
SELECT sent_id, arg_min(text, i) AS root FROM e WHERE dep = 'ROOT' GROUP BY sent_id""")
def q_phrase_root(spark, sf):
    return LK.phrase_root(_edges(spark, sf))
