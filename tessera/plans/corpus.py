"""Counting queries on ``documents``: term counts, n-grams, topic-model lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.sequences import hash_bucket
from tessera.operators import lookup, topics
from tessera.plans.registry import query
from tessera.plans.sqlparts import bucket, lit, toks
from tessera.session import scratch_path, stored
from tessera.sources import files
from tessera.sources.tables import table

STOP_K = 50

@query("term_counts", sql=f"""
SELECT doc_id, token, count(*)::BIGINT AS n
FROM (SELECT doc_id, unnest({toks('text')}) AS token FROM documents)
GROUP BY doc_id, token
""")
def q_term_counts(spark, sf):
    return topics.term_counts(table(spark, sf, "documents"))


@query("ngram_counts", sql=f"""
WITH t AS (SELECT doc_id, {toks('text')} AS tk FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(tk)), lambda i: tk[i] || '_' || tk[i + 1])) AS ngram FROM t)
SELECT doc_id, ngram, count(*)::BIGINT AS n FROM g GROUP BY doc_id, ngram HAVING count(*) >= 2
""")
def q_ngram_counts(spark, sf):
    return topics.ngram_counts(table(spark, sf, "documents"), n=2, min_count=2)


# Stand-in input: the lists of the query's two list languages.  German texts play the Russian ones; by rule H a
# document's language is given by code or by name.
_NAMED = """CASE WHEN p.lang_pred = 'de' THEN CASE WHEN {b} < 500 THEN 'ru' ELSE 'Russian' END
                 WHEN p.lang_pred = 'en' THEN CASE WHEN {b} < 500 THEN 'en' ELSE 'ENGLISH' END ELSE p.lang_pred END"""


def _named(lang):
    half = hash_bucket("doc_id") < 500
    return (F.when(F.col(lang) == "de", F.when(half, "ru").otherwise("Russian"))
            .when(F.col(lang) == "en", F.when(half, "en").otherwise("ENGLISH")).otherwise(F.col(lang)))


@query("vw_lines", sql=f"""
WITH words AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest({toks('text')}) AS word FROM documents) GROUP BY lang, word),
profiles AS (SELECT lang, word FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM words) WHERE r <= {STOP_K}),
stop AS (SELECT CASE lang WHEN 'de' THEN 'ru' ELSE lang END AS lang, word FROM profiles WHERE lang IN ('de', 'en')),
lemmas AS (SELECT DISTINCT CASE lang WHEN 'de' THEN 'ru' ELSE lang END AS lang, word AS form, substr(word, 1, len(word) - 1) AS lemma
           FROM words WHERE lang IN ('de', 'en') AND len(word) > 4 AND regexp_full_match(word, '[a-z]+s')),
hits AS (SELECT t.doc_id, p.lang, count(*) AS hits FROM (SELECT doc_id, unnest({toks('text')}) AS word FROM documents) t
         JOIN profiles p ON t.word = p.word GROUP BY t.doc_id, p.lang),
best AS (SELECT doc_id, min({{'nh': -hits, 'l': lang}}).l AS lang_pred FROM hits GROUP BY doc_id),
d AS (SELECT d.doc_id, d.text, {_NAMED.format(b=bucket('d.doc_id'))} AS lang FROM documents d LEFT JOIN best p ON d.doc_id = p.doc_id),
c1 AS (SELECT doc_id, CASE WHEN lower(lang) IN ('ru', 'russian') THEN 'ru' WHEN lower(lang) IN ('en', 'english') THEN 'en' END AS lang,
         translate(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), {lit(topics.NUMBER_PATTERN)}, '', 'g'),
                   {lit(topics.TOPIC_PUNCTUATION)}, '') AS t FROM d),
c2 AS (SELECT doc_id, lang, {toks('t', lower=False)} AS tk FROM c1),
c3 AS (SELECT doc_id, lang,
         trim(regexp_replace(array_to_string(list_filter(tk, lambda x, i: i < len(tk) AND x <> tk[i + 1]), ' '),
                             {lit(topics.IMAGE_PATTERN)}, '', 'g')) AS clean FROM c2),
raw AS (SELECT doc_id, lang, generate_subscripts(w, 1) AS pos, unnest(w) AS tok FROM (SELECT doc_id, lang, {toks('clean')} AS w FROM c3 WHERE lang IS NOT NULL)),
kept AS (SELECT r.doc_id, pos, CASE WHEN digits THEN tok ELSE coalesce(l.lemma, tok) END AS tok
         FROM (SELECT *, lang = 'ru' AND regexp_full_match(tok, '[0-9]+') AS digits FROM raw) r
         LEFT JOIN stop s ON r.lang = s.lang AND r.tok = s.word LEFT JOIN lemmas l ON r.lang = l.lang AND r.tok = l.form
         WHERE (digits OR s.word IS NULL) AND CASE WHEN digits THEN tok ELSE coalesce(l.lemma, tok) END <> '-'),
pairs AS (SELECT doc_id, pos, tok || '_' || lead(tok) OVER (PARTITION BY doc_id ORDER BY pos) AS tok FROM kept),
cnt AS (SELECT doc_id, tok, count(*) AS n, min(pos) AS first, 0 AS kind FROM kept GROUP BY doc_id, tok
        UNION ALL
        SELECT doc_id, tok, count(*) AS n, min(pos) AS first, 1 AS kind FROM pairs WHERE tok IS NOT NULL GROUP BY doc_id, tok HAVING count(*) >= 2),
lines AS (SELECT doc_id, 'doc' || CAST(doc_id AS VARCHAR) || ' ' || string_agg(tok || ':' || CAST(n AS VARCHAR), ' ' ORDER BY kind, first) AS line
          FROM cnt GROUP BY doc_id)
SELECT d.doc_id, coalesce(l.line, '') AS line FROM documents d LEFT JOIN lines l ON d.doc_id = l.doc_id
""")
def q_vw_lines(spark, sf):
    """The topic lines of all documents: the language is detected by word lists, then the list language's stop words and
    lemmas apply.  Word and lemma lists are files that the query writes from the corpus first."""
    docs = table(spark, sf, "documents")
    counts = stored(topics.language_word_counts(docs), "language-words")
    profiles, stop, lemma = (scratch_path(spark, name) for name in ("profiles", "stop-lists", "lemma-lists"))
    files.write_word_lists(topics.most_frequent(counts, STOP_K), profiles)
    profiles = files.read_word_lists(spark, profiles)
    played = F.when(F.col("lang") == "de", "ru").otherwise(F.col("lang"))
    files.write_word_lists(profiles.where(F.col("lang").isin("de", "en")).select(played.alias("lang"), "word"), stop)
    forms = counts.where(F.col("lang").isin("de", "en") & (F.length("word") > 4) & F.col("word").rlike("^[a-z]+s$"))
    files.write_word_lists(forms.select(played.alias("lang"), F.concat("word", F.lit("\t"), F.expr("substr(word, 1, length(word) - 1)")).alias("word")), lemma)
    named = lookup.detect_language(docs, profiles).select("doc_id", _named("lang_pred").alias("lang"))
    return topics.vw_dataset(docs.select("doc_id", "text").join(named, "doc_id"), files.read_word_lists(spark, stop),
                             files.read_lemmas(spark, lemma), which_n_grams=(2,), min_count=2)
