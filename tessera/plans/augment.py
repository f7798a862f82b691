"""Augmentation queries: typos, lexicon round trip, the 1.36x augmented set."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import tokens
from tessera.operators import augment as A
from tessera.plans.registry import query
from tessera.plans.sqlparts import bucket, lit, toks
from tessera.session import stored
from tessera.sources.tables import table


def _typo_step_sql(t: str, s: int, seed: int = 9) -> str:
    h = lambda kind: f"(('0x' || substr(md5('{seed}:' || CAST(doc_id AS VARCHAR) || ':{s}:{kind}'), 1, 8))::BIGINT)"
    n = f"length({t})"
    idx = f"({h('p')} % greatest({n}, 1))"
    ch = f"substr({lit(A.TYPO_ALPHABET)}, ({h('c')} % {len(A.TYPO_ALPHABET)} + 1)::INTEGER, 1)"
    return (f"CASE WHEN {n} = 0 THEN {t} "
            f"WHEN {h('k')} % 3 = 0 THEN substr({t}, 1, {idx}) || {ch} || substr({t}, {idx} + 1) "
            f"WHEN {h('k')} % 3 = 1 AND {n} > 1 THEN substr({t}, 1, {idx}) || substr({t}, {idx} + 2) "
            f"WHEN {h('k')} % 3 = 2 THEN substr({t}, 1, {idx}) || {ch} || substr({t}, {idx} + 2) "
            f"ELSE {t} END")


def _typos_sql(src: str) -> str:
    return f"""s1 AS (SELECT doc_id, {_typo_step_sql('text', 1)} AS text FROM {src}),
s2 AS (SELECT doc_id, {_typo_step_sql('text', 2)} AS text FROM s1)"""


@query("typos", sql=f"WITH {_typos_sql('documents')} SELECT doc_id, text FROM s2")
def q_typos(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", A.apply_typos("text", F.col("doc_id"), 2).alias("text"))


def _lexicons(rows):
    """Lexicons derived by rule from the corpus vocabulary: a word's pivot is its
    lower-case form (one-to-one in every engine, unlike upper-casing ß); the way
    back picks the smallest word with that pivot."""
    vocab = stored(rows.select(F.col("token").alias("word")).distinct(), "words")
    forward = vocab.select("word", F.lower("word").alias("pivot"))
    backward = forward.groupBy("pivot").agg(F.min("word").alias("word"))
    return forward, backward


def _token_rows(df):
    return df.select("doc_id", F.posexplode(tokens("text", lower=False)).alias("pos", "token"))


_LEX_SQL = f"""
tr AS (SELECT doc_id, (generate_subscripts(t, 1) - 1)::INTEGER AS pos, unnest(t) AS token
       FROM (SELECT doc_id, {toks('text', lower=False)} AS t FROM SRC)),
bw AS (SELECT lower(token) AS pivot, min(token) AS word FROM (SELECT DISTINCT token FROM tr) GROUP BY 1),
rt AS (SELECT tr.doc_id, string_agg(coalesce(bw.word, tr.token), ' ' ORDER BY tr.pos) AS text
       FROM tr LEFT JOIN bw ON lower(tr.token) = bw.pivot GROUP BY tr.doc_id)"""


@query("lexicon_round_trip", sql=f"WITH {_LEX_SQL.replace('SRC', 'documents').strip()} SELECT doc_id, text FROM rt")
def q_lexicon_round_trip(spark, sf):
    rows = _token_rows(table(spark, sf, "documents"))
    fwd, bwd = _lexicons(rows)
    return A.lexicon_round_trip(rows, "doc_id", "pos", "token", fwd, bwd)


@query("augmented", sql=f"""
WITH a_src AS (SELECT doc_id, text FROM documents WHERE {bucket('doc_id')} < 200),
b_src AS (SELECT doc_id, text FROM documents WHERE {bucket('doc_id')} >= 200 AND {bucket('doc_id', seed=43)} < 200),
{_LEX_SQL.replace('SRC', 'a_src').strip()},
{_typos_sql('b_src')}
SELECT doc_id, text, 'orig' AS kind FROM documents
UNION ALL SELECT doc_id, text, 'a' FROM rt
UNION ALL SELECT doc_id, text, 'b' FROM s2""")
def q_augmented(spark, sf):
    docs = table(spark, sf, "documents")

    def branch_a(part):
        rows = _token_rows(part)
        fwd, bwd = _lexicons(rows)
        return A.lexicon_round_trip(rows, "doc_id", "pos", "token", fwd, bwd)

    def branch_b(part):
        return part.select("doc_id", A.apply_typos("text", F.col("doc_id"), 2).alias("text"))

    return A.augment(docs, "doc_id", "text", branch_a, branch_b).select("doc_id", "text", "kind")
