"""Text extraction and cleaning queries (TX1-TX22) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.sequences import hash_bucket
from tessera.operators import cleaning
from tessera.plans import derived
from tessera.plans.registry import query
from tessera.plans.sqlparts import bucket, first_n, lit, toks
from tessera.session import stored
from tessera.sources.tables import table

NL = "chr(10)"


def _html_text_sql(expr: str) -> str:
    h = expr
    for pat in T.HTML_DROP:
        h = f"regexp_replace({h}, {lit(pat)}, '', 'g')"
    h = f"regexp_replace({h}, {lit(T.HTML_TAG)}, '', 'g')"
    for a, b in T.HTML_ENTITIES:
        h = f"replace({h}, {lit(a)}, {lit(b)})"
    return h


@query("clean_text", sql="SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS clean FROM documents")
def q_clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.clean_string("text").alias("clean"))


@query("first_300_tokens", sql=f"SELECT doc_id, {first_n('text')} AS text FROM documents")
def q_first_300(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.first_n_tokens("text", 300).alias("text"))


@query("conversation_text", sql=f"""
SELECT conv_id, {first_n("string_agg(text, ' ' ORDER BY turn)")} AS text FROM conversations GROUP BY conv_id
""")
def q_conversation_text(spark, sf):
    return cleaning.ordered_concat(table(spark, sf, "conversations"), "conv_id", "turn", "text", n_tokens=300)


@query("page_text", sql=f"SELECT page_id, {first_n(_html_text_sql('html'))} AS text FROM pages")
def q_page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.first_n_tokens(T.html_text("html"), 300).alias("text"))


_CELLS_SQL = ("list_transform(regexp_extract_all(regexp_extract_all(html, '(?s)<ul\\b[^>]*>(.*?)</ul>', 1)[1], "
              "'(?s)<li\\b[^>]*>(.*?)</li>', 1), lambda x: trim(regexp_replace(regexp_replace(x, "
              f"{lit(T.HTML_TAG)}, '', 'g'), '\\s+', ' ', 'g')))")


@query("page_cells", sql=f"""
SELECT page_id, (generate_subscripts(c, 1) - 1)::INTEGER AS pos, unnest(c) AS cell
FROM (SELECT page_id, {_CELLS_SQL} AS c FROM pages)
""")
def q_page_cells(spark, sf):
    return cleaning.page_cells(table(spark, sf, "pages"), "page_id", "html", block_tag="ul", cell_tag="li", index=0)


@query("term_urls", sql=f"""
SELECT page_id, pos, 'https://example.org/wiki/' || replace(url_encode(cell), '%2F', '/') AS url
FROM (SELECT page_id, (generate_subscripts(c, 1) - 1)::INTEGER AS pos, unnest(c) AS cell
      FROM (SELECT page_id, {_CELLS_SQL} AS c FROM pages))
""")
def q_term_urls(spark, sf):
    cells = cleaning.page_cells(table(spark, sf, "pages"), "page_id", "html", block_tag="ul", cell_tag="li", index=0)
    return cells.select("page_id", "pos", T.term_url("cell", "https://example.org/wiki/").alias("url"))


@query("markup_line_clean", sql="""
SELECT page_id, (generate_subscripts(l, 1) - 1)::INTEGER AS pos,
       split_part(string_split(unnest(l), '>')[-2], '<', 1) AS term
FROM (SELECT page_id, regexp_extract_all(html, '(?s)<a\\b[^>]*>.*?</a>', 0) AS l FROM pages)
""")
def q_markup_line_clean(spark, sf):
    pages = table(spark, sf, "pages")
    lines = F.regexp_extract_all("html", F.lit("(?s)<a\\b[^>]*>.*?</a>"), 0)
    return (pages.select("page_id", F.posexplode(lines).alias("pos", "line"))
            .select("page_id", "pos", T.markup_line_clean("line").alias("term")))


@query("table_rows_text", sql=f"""
WITH r AS (SELECT p_brand, p_partkey,
                  concat_ws(' ', CASE WHEN p_partkey <> 0 THEN CAST(p_partkey AS VARCHAR) END, trim(regexp_replace(p_name, '\\s+', ' ', 'g')),
                            trim(regexp_replace(p_type, '\\s+', ' ', 'g')),
                            CASE WHEN p_size <> 0 THEN CAST(p_size AS VARCHAR) END) AS row_text,
                  row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part)
SELECT p_brand, {first_n("'p_partkey p_name p_type p_size ' || string_agg(row_text, ' ' ORDER BY p_partkey)")} AS text
FROM r WHERE rn <= 49 GROUP BY p_brand
""")
def q_table_rows_text(spark, sf):
    part = table(spark, sf, "part")
    return cleaning.table_rows_text(part, "p_brand", "p_partkey", ["p_partkey", "p_name", "p_type", "p_size"],
                                    max_rows=49, n_tokens=300)


def _phrase_sql(x: str) -> str:
    for pat in cleaning.BRACKET_PATTERNS:
        x = f"regexp_replace({x}, {lit(pat)}, '', 'g')"
    x = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    x = f"(CASE WHEN starts_with({x}, 'to') THEN substr({x}, 4) ELSE {x} END)"
    for b in cleaning.PHRASE_BLOCK:
        x = f"replace({x}, {lit(b)}, '')"
    x = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    return f"regexp_replace({x}, {lit(cleaning.BRACKET_PATTERNS[0])}, '', 'g')"


_BLOCK_LIST = "[" + ", ".join(lit(b) for b in cleaning.PHRASE_BLOCK) + "]"


@query("phrase_clean", sql=f"""
SELECT DISTINCT {_phrase_sql('line')} AS phrase
FROM (SELECT unnest(string_split(text, {NL})) AS line FROM documents)
WHERE NOT list_contains({_BLOCK_LIST}, line)
""")
def q_phrase_clean(spark, sf):
    lines = table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return cleaning.clean_phrases(lines, "line")


@query("block_split", sql=f"""
SELECT doc_id, pos, line FROM (
  SELECT doc_id, (generate_subscripts(l, 1) - 1)::INTEGER AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, {NL}) AS l FROM documents))
WHERE line NOT IN ('m', 'f', 'mf', 'n', 'Show more')
""")
def q_block_split(spark, sf):
    return cleaning.block_split(table(spark, sf, "documents"), "doc_id", "text")


# Stand-in input: by rule H half of the texts get some Cyrillic letters, a tenth of them only one that is outside the range.
_SOME = ("aeo", "аео")
_YO = ("e", "ё")


@query("cyrillic_flag", sql=f"""
SELECT doc_id, regexp_matches(CASE WHEN b < 400 THEN translate(text, '{_SOME[0]}', '{_SOME[1]}') WHEN b < 500 THEN replace(text, '{_YO[0]}', '{_YO[1]}') ELSE text END,
                              '[\\x{{0410}}-\\x{{044F}}]') AS is_russian
FROM (SELECT doc_id, text, {bucket('doc_id')} AS b FROM documents)
""")
def q_cyrillic_flag(spark, sf):
    b = hash_bucket("doc_id")
    text = F.when(b < 400, F.translate("text", *_SOME)).when(b < 500, F.translate("text", *_YO)).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", T.is_cyrillic(text).alias("is_russian"))


@query("label_repair", sql=f"""
WITH {derived.TAGS_SQL.strip()},
l AS (SELECT doc_id, pos, token, tag, {bucket("doc_id || ':' || pos")} % 20 AS b FROM tags)
SELECT doc_id, pos, token, CASE WHEN b = 1 THEN 'O' WHEN b = 2 AND tag <> 'O' THEN 'B-1' ELSE tag END AS label
FROM l WHERE b <> 0
""")
def q_label_repair(spark, sf):
    """Lines of token and tag; by rule H a line has six fields, a Cyrillic label, or ``True`` in its label."""
    b = F.col("b")
    label = F.when(b == 1, F.concat(F.lit("Б-"), "tag")).when((b == 2) & (F.col("tag") != "O"), "B-True").otherwise(F.col("tag"))
    rows = derived.tag_rows(table(spark, sf, "documents")).withColumn("b", hash_bucket("doc_id", "pos") % 20)
    lines = rows.select("doc_id", "pos", F.concat_ws(" ", "token", label, F.when(b == 0, "x y z v")).alias("line"))
    return cleaning.repair_labels(lines, "line", label_index=1)


@query("tag_whitelist", sql=f"""
WITH {derived.TAGS_SQL.strip()}
SELECT doc_id, pos, token, CASE WHEN tag IN ('O', 'B-CAP', 'I-CAP') THEN tag ELSE 'O' END AS tag FROM tags
""")
def q_tag_whitelist(spark, sf):
    rows = derived.tag_rows(table(spark, sf, "documents"))
    return rows.select("doc_id", "pos", "token", cleaning.whitelist_tag("tag", ["CAP"]).alias("tag"))


# Stand-in input: decoded texts of which, by rule H, two in three hold a separator, some of them at their beginning.
_SEP = "[SEP]"


@query("cut_at_separator", sql=f"""
WITH d AS (SELECT doc_id, CASE WHEN b < 100 THEN '{_SEP} ' || text WHEN b < 667 THEN replace(text, ' a', ' {_SEP} a') ELSE text END AS text
           FROM (SELECT doc_id, text, {bucket('doc_id')} AS b FROM documents))
SELECT doc_id, CASE WHEN contains(text, '{_SEP}') THEN substr(text, 1, greatest(position('{_SEP}' IN text) - 2, 0)) ELSE text END AS text FROM d
""")
def q_cut_at_separator(spark, sf):
    """TX16, the variant that cuts one character before its marker."""
    b = hash_bucket("doc_id")
    text = (F.when(b < 100, F.concat(F.lit(_SEP + " "), "text")).when(b < 667, F.replace("text", F.lit(" a"), F.lit(f" {_SEP} a"))).otherwise(F.col("text")))
    d = table(spark, sf, "documents").select("doc_id", text.alias("text"))
    return d.select("doc_id", T.cut_at_marker("text", _SEP, keep_marker=False).alias("text"))


_LIMIT = 512


@query("length_filter", sql=f"""
SELECT doc_id, n_words, n_pieces FROM (
  SELECT doc_id, len({toks('text')})::INTEGER AS n_words,
         len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s]', 0))::INTEGER AS n_pieces
  FROM documents) WHERE n_words <= 512 AND n_pieces <= 512
""")
def q_length_filter(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.tokens("text").alias("a"), T.word_pieces("text").alias("b"))
    kept = d.where(T.limit_ok("a", "b", 512))
    return kept.select("doc_id", F.size("a").alias("n_words"), F.size("b").alias("n_pieces"))


@query("discard_report", sql=f"""
WITH p AS (SELECT page_id, len({toks('html')}) AS a, len(regexp_extract_all(url, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s]', 0)) AS b FROM pages),
r AS (SELECT count(*) AS n_rows, count(*) FILTER (a <= {_LIMIT} AND b <= {_LIMIT}) AS n_kept, count(*) FILTER (a > {_LIMIT} OR b > {_LIMIT}) AS n_discarded,
             count(*) FILTER (a > {_LIMIT}) AS n_long_html, count(*) FILTER (b > {_LIMIT}) AS n_long_url FROM p)
SELECT page_id, r.* FROM p, r WHERE a <= {_LIMIT} AND b <= {_LIMIT}""")
def q_discard_report(spark, sf):
    """Pages whose html and url both have at most the limit of tokens, each with the counts of the pass that kept it."""
    p = table(spark, sf, "pages").select("page_id", T.tokens("html").alias("a"), T.word_pieces("url").alias("b"))
    kept, report = cleaning.limit_by_tokens(p, "a", "b", _LIMIT)
    kept = stored(kept.select("page_id"), "kept-pages")
    names = {"n_rows": "n_rows", "n_kept": "n_kept", "n_discarded": "n_discarded", "n_long_a": "n_long_html", "n_long_b": "n_long_url"}
    return kept.select("page_id", *[F.lit(report.get[k]).cast("bigint").alias(n) for k, n in names.items()])


_ROWS_OF_A_PAGE = 20


def _part_pages(spark, sf):
    """Stand-in input: pages with a menu table and a table of parts, a part a row."""
    escaped = lambda c: F.replace(F.replace(F.replace(F.col(c).cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("e"), F.lit("&#x65;"))
    cells = F.concat(*[F.concat(F.lit("<td class=c>\n <b>"), escaped(c), F.lit("</b> </td>")) for c in ("p_partkey", "p_name", "p_type", "p_size")])
    rows = table(spark, sf, "part").select(F.floor(F.col("p_partkey") / _ROWS_OF_A_PAGE).alias("page"), F.struct("p_partkey", F.concat(F.lit("<TR>"), cells, F.lit("</TR >")).alias("r")).alias("r"))
    body = rows.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["r"]), "\n").alias("b"))
    head = "<html><table id=menu><tr><td>Home</td><td>Parts</td></tr></table><p>List</p><table><tr><th>Key</th><th>Name</th><th>Type</th><th>Size</th></tr>"
    return body.select("page", F.concat(F.lit(head), "b", F.lit("</table></html>")).alias("html"))


@query("table_rows", sql=f"""
SELECT p_partkey // {_ROWS_OF_A_PAGE} AS page, (row_number() OVER (PARTITION BY p_partkey // {_ROWS_OF_A_PAGE} ORDER BY p_partkey))::INTEGER AS row_no,
       p_partkey, p_name, p_type, p_size::INTEGER AS p_size FROM part""")
def q_table_rows(spark, sf):
    """The rows of each page's second table, without its header."""
    rows = _part_pages(spark, sf).select("page", F.posexplode(F.get(T.html_tables("html"), F.lit(1))).alias("row_no", "c")).where(F.col("row_no") > 0)
    return rows.select("page", "row_no", F.col("c")[0].cast("bigint").alias("p_partkey"), F.col("c")[1].alias("p_name"), F.col("c")[2].alias("p_type"),
                       F.col("c")[3].cast("int").alias("p_size"))


@query("form_class", sql=f"""
SELECT doc_id, CASE WHEN length(t[3]) <= 3 THEN 'infinitive' WHEN length(t[1]) <= 3 THEN 'impersonal'
                    ELSE 'personal' END AS form_class
FROM (SELECT doc_id, {toks('text', lower=False)} AS t FROM documents)
""")
def q_form_class(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.tokens("text", lower=False).alias("t"))
    return d.select(
        "doc_id", T.form_class(F.get("t", 0), F.get("t", 2)).alias("form_class"))




def _qsql() -> str:
    from tessera.operators import quantity as Q
    L = lambda xs: "[" + ", ".join(lit(x) for x in xs) + "]"
    dc = lambda e: f"regexp_replace(regexp_replace({e}, {lit(Q.COMMA_BETWEEN)}, '\\1\\2', 'g'), {lit(Q.COMMA_BETWEEN)}, '\\1\\2', 'g')"
    th = L(Q.THOUSANDS)
    pre = lambda e, p, k: f"(CASE WHEN starts_with({e}, {lit(p)}) AND length({e}) > {len(p) + k} THEN replace({e}, {lit(p)}, '') ELSE {e} END)"
    tok = pre(pre(pre("x", "ед.", 1), "eд.", 1), "единиц", 3)
    isnum = (f"(regexp_full_match(x, '\\p{{Nd}}+') OR list_contains({L(Q.NUMBERS)}, x) OR list_contains({L(Q.ORDINALS)}, x) "
             f"OR x = {lit(Q.FEW)})")
    dash = lambda e: f"(CASE WHEN ends_with({e}, '-') THEN trim(substr({e}, 1, length({e}) - 1)) ELSE {e} END)"
    return f"""
WITH l AS (SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INTEGER AS line_no, unnest(ls) AS line
           FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
t AS (SELECT doc_id, line_no, {toks('line', lower=False)} AS tk FROM l),
r AS (SELECT doc_id, line_no, array_to_string(list_transform(tk, lambda x, i: CASE
        WHEN list_contains({th}, x) AND i > 1 AND regexp_matches(tk[i - 1], {lit(Q.DIGIT_COMMA)}) THEN '00'
        WHEN list_contains({th}, x) THEN '000'
        WHEN regexp_matches(x, {lit(Q.DIGIT_COMMA)}) AND i < len(tk) AND list_contains({th}, tk[i + 1]) THEN {dc('x')}
        ELSE x END), ' ') AS j FROM t),
s AS (SELECT doc_id, line_no, {dc("regexp_replace(j, '(\\p{Nd}) +(\\p{Nd})', '\\1\\2', 'g')")} AS j2 FROM r),
u AS (SELECT doc_id, line_no, list_transform({toks('j2', lower=False)}, lambda x: translate({tok}, {lit(Q.EXCL_SYMS)}, '')) AS t FROM s),
v AS (SELECT *, coalesce(list_position(list_transform(t, lambda x: {isnum}), true), 0) AS ind, len(t) AS n,
             list_filter(t, lambda x: NOT list_contains({L(Q.EXCL_TOKS)}, x)) AS a,
             list_filter(t, lambda x: NOT list_contains({L(Q.UNIT_WORDS)}, x)) AS b FROM u),
w AS (SELECT *, coalesce(list_contains({L(Q.EXCL_TOKS)}, t[-1]), false) AS last_unit,
             coalesce(regexp_full_match(t[n], '\\p{{Nd}}+'), false)
             OR coalesce(regexp_full_match(CASE WHEN n >= 2 THEN t[n - 1] END, '\\p{{Nd}}+'), false) AS last_two FROM v)
SELECT doc_id, line_no,
       CASE WHEN ind = 0 THEN '1' WHEN last_unit THEN lower(t[ind])
            WHEN NOT last_two OR n <= 4 THEN lower(array_to_string(t[1:ind], ' ')) ELSE '1' END AS number,
       CASE WHEN ind = 0 THEN array_to_string(t, ' ') WHEN last_unit THEN {dash("array_to_string(a[1:len(a) - 1], ' ')")}
            WHEN NOT last_two OR n <= 4 THEN {dash("array_to_string(b[ind + 1:len(b)], ' ')")}
            ELSE array_to_string(t, ' ') END AS rest
FROM w"""


@query("quantity_extract", sql=_qsql())
def q_quantity_extract(spark, sf):
    from tessera.operators.quantity import extract_quantity
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return extract_quantity(lines, "line").select("doc_id", "line_no", "number", "rest")
