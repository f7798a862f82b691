"""DuckDB SQL of the queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "coalesce(regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

OP1 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
tests AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS words
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM tests))),
hits AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN tests t ON p.n = t.n AND p.words = t.words),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) WHERE item IS NOT NULL GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

OP8 = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
    SELECT *, length(url_encode(role)) + length(text) + 24 + len(regexp_extract_all(
        text, '[<\[]\\*(?:\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>|/?INST\])')) AS n
    FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP10 = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
windows AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS n
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
repeats AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY doc_id),
lines AS (
    SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
    SELECT d.doc_id, d.source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
           OR 10 * n_dup_lines > 3 * n_lines AS failed
    FROM m),
hosts AS (SELECT source, count(*) AS docs, sum(failed::INT)::DOUBLE AS failures FROM judged GROUP BY source),
prior AS (
    SELECT m, greatest(CASE WHEN v > 0 THEN m * (1 - m) / v - 1 ELSE n END, 0) AS s
    FROM (SELECT avg(failures / docs) AS m, var_pop(failures / docs) AS v, sum(docs) AS n FROM hosts)),
verdicts AS (SELECT source, round((failures + m * s) / (docs + s), 9) >= 0.8 AS host_rejected FROM hosts, prior)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_rejected AS kept
FROM judged j JOIN verdicts v ON j.source IS NOT DISTINCT FROM v.source
"""

_FLOOR_MEAN = "CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"


def _nearest(r: int, by: str) -> str:
    """a{r}: the nearest centre of each row; rows and centres are in long form, a component a row."""
    return f"""a{r} AS MATERIALIZED (
    SELECT {by}vec_id, c, dist FROM (
        SELECT *, row_number() OVER (PARTITION BY {by}vec_id ORDER BY dist, c) AS n
        FROM (SELECT {by}vec_id, c, sum((x - m) * (x - m)) AS dist FROM x JOIN c{r} USING ({by}d) GROUP BY {by}vec_id, c))
    WHERE n = 1)"""


def _moved(r: int, by: str) -> str:
    """c{r + 1}: the floors of the means; centres without rows stay."""
    return f"""c{r + 1} AS MATERIALIZED (
    SELECT {by}c, d, coalesce(s.m, o.m) AS m
    FROM c{r} o LEFT JOIN (SELECT {by}c, d, {_FLOOR_MEAN} AS m FROM x JOIN a{r} USING ({by}vec_id) GROUP BY {by}c, d) s USING ({by}c, d))"""


def _rounds(n: int, by: str = "") -> str:
    return ",\n".join([s for r in range(n) for s in (_nearest(r, by), _moved(r, by))] + [_nearest(n, by)])


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = len(embedding)"

OP11 = f"""
WITH v AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
x AS MATERIALIZED (
    SELECT vec_id, d, CAST(floor(64 * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS d FROM v)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM v),
c0 AS MATERIALIZED (SELECT c, d, x AS m FROM first JOIN x USING (vec_id) WHERE c < 16),
{_rounds(3)},
sums AS (SELECT c, sum(dist) AS s FROM a3 GROUP BY c),
digests AS (SELECT c, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY d)) AS digest FROM c3 GROUP BY c)
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(dist AS BIGINT) AS distance, CAST(s AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(s) FROM sums) AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a3 JOIN sums USING (c) JOIN digests USING (c)
"""

OP12 = f"""
WITH v AS (
    SELECT vec_id, label, embedding, len(embedding) // 4 AS width FROM embeddings WHERE {_FINITE}),
x AS MATERIALIZED (
    SELECT vec_id, d // width AS p, d % width AS d, CAST(floor(1024 * CAST(embedding[d + 1] AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT vec_id, embedding, width, unnest(range(0, len(embedding))) AS d FROM v)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS c FROM v),
c0 AS MATERIALIZED (SELECT p, c, d, x AS m FROM first JOIN x USING (vec_id) WHERE c < 256),
{_rounds(4, "p, ")},
codes AS (
    SELECT vec_id, string_agg(lower(printf('%02x', CAST(c AS INT))), '' ORDER BY p) AS code, sum(dist) AS error
    FROM a4 GROUP BY vec_id),
sums AS (SELECT label, sum(error) AS s FROM codes JOIN v USING (vec_id) GROUP BY label)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(s AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY p, c, d)) FROM c4) AS codebooks_sha256
FROM codes JOIN v USING (vec_id) JOIN sums ON v.label IS NOT DISTINCT FROM sums.label
"""
