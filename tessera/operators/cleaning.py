"""Cleaning and extraction operators on DataFrames (TX9-TX20).

Per-row work is built-in expressions; the only groupings are per key and are
bounded before they collect: a group-limit window keeps at most ``n`` rows per
key (Catalyst plans it as ``WindowGroupLimit``, which also limits map-side
before the shuffle), so a hot key never collects more than ``n`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera.functions import text as T

# Bracketed spans removed from scraped phrases.  Each pattern runs
# to the last closing bracket reachable without crossing ``)``.
BRACKET_PATTERNS = ("\\[[^)]*\\]", "\\([^)]*\\)", "\\<[^)]*\\>", "\\{[^)]*\\}")

# Block-list substrings removed from scraped phrases, in order.
PHRASE_BLOCK = ("idiom ", "cloth.", "hist.", "art.", "relig.", "meteo.", "hist.", "anat.", "cosmet.",
                "gastr.", "unit", "ecol.", "med.", "sports", "pol.", "econ.", "zool.", "geogr.", "sociol.",
                "lit.", "ling", "RealEst.", "naut.", "journ.", "lit.", "sb.", "ethn.", "curr. neol.", "sth.",
                "publ.", "comm. FoodInd.", "educ.", "orn.", "neol.", "fin.", "mus.", "spec.", "psych.", "mil.",
                "comm.", "automot.", "FoodInd.", "agr. equest.", "constr.", "archi.", "agr.")

# Interface tokens dropped from scraped translation blocks.
UI_TOKENS = ("m", "f", "mf", "n", "Show more")


def phrase_clean(c) -> Column:
    """TX9 for one phrase: brackets, whitespace, ``to`` prefix (3 chars), block
    substrings, whitespace, square brackets again."""
    x = T._c(c)
    for pat in BRACKET_PATTERNS:
        x = F.regexp_replace(x, pat, "")
    x = T.clean_string(x)
    x = F.when(x.startswith("to"), F.substring(x, 4, 1 << 30)).otherwise(x)
    for b in PHRASE_BLOCK:
        x = F.replace(x, F.lit(b), F.lit(""))
    x = T.clean_string(x)
    return F.regexp_replace(x, BRACKET_PATTERNS[0], "")


def clean_phrases(df: DataFrame, col: str, skip_exact: bool = True) -> DataFrame:
    """TX9 + ST4: distinct cleaned phrases; rows equal to a block entry are
    skipped first when ``skip_exact``."""
    if skip_exact:
        df = df.where(~F.col(col).isin(*PHRASE_BLOCK))
    return df.select(phrase_clean(col).alias("phrase")).distinct()


def block_split(df: DataFrame, key: str, text: str, drop=UI_TOKENS) -> DataFrame:
    """TX11: lines of a block with interface tokens removed; ``pos`` is the
    0-based line number in the block."""
    return (df.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
            .where(~F.col("line").isin(*drop)))


def ordered_concat(df: DataFrame, key: str, order: str, text: str, n_tokens: int = 300) -> DataFrame:
    """TX20: fragments of a key in ``order`` joined into one text, cut to the
    first ``n_tokens`` tokens.  Only the first ``n_tokens`` non-empty fragments
    can contribute, so a group limit bounds what each key collects; empty
    fragments sort last and keep keys with no text."""
    empty = (T.clean_string(F.col(text)) == "") | F.col(text).isNull()
    w = Window.partitionBy(key).orderBy(empty.cast("int"), F.col(order))
    top = df.select(key, order, text, F.row_number().over(w).alias("_r")).where(F.col("_r") <= n_tokens)
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    g = top.groupBy(key).agg(parts.alias("_p"))
    joined = F.array_join(F.transform("_p", lambda p: F.coalesce(p["t"], F.lit(""))), " ")
    return g.select(key, T.first_n_tokens(joined, n_tokens).alias("text"))


def page_cells(df: DataFrame, key: str, html: str, block_tag: str = "table", cell_tag: str = "td",
               index: int = 0) -> DataFrame:
    """TX18: cells of the ``index``-th block (0-based) of each page, as
    ``(key, pos, cell)``."""
    block = F.get(T.html_blocks(html, block_tag), index)
    return df.select(key, F.posexplode(T.html_cells(block, cell_tag)).alias("pos", "cell"))


def table_rows_text(df: DataFrame, group: str, order: str, cols: Sequence[str], max_rows: int = 49,
                    n_tokens: int = 300) -> DataFrame:
    """TX19: header (minus unnamed columns) + first ``max_rows`` rows, blank and
    zero cells dropped, cut to ``n_tokens``.  Per group, a group limit keeps
    ``max_rows`` rows before anything is collected."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    header = " ".join(_norm_header(c) for c in cols if "nnam" not in c)
    cells = []
    for c in cols:
        if isinstance(types[c], NumericType):
            cells.append(F.when(F.col(c) != 0, F.col(c).cast("string")))
        else:
            cells.append(T.clean_string(F.col(c)))
    w = Window.partitionBy(group).orderBy(order)
    top = (df.select(group, order, F.concat_ws(" ", *cells).alias("_row"), F.row_number().over(w).alias("_r"))
           .where(F.col("_r") <= max_rows))
    g = top.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(order, "_row"))).alias("_rows"))
    body = F.array_join(F.transform("_rows", lambda r: r["_row"]), " ")
    return g.select(group, T.first_n_tokens(F.concat_ws(" ", F.lit(header), body), n_tokens).alias("text"))


def _norm_header(s: str) -> str:
    return " ".join(s.split())


def limit_by_tokens(df: DataFrame, a: str, b: str, n: int = 512, name: str = "limit_by_tokens") -> tuple[DataFrame, Observation]:
    """TX15: the rows whose token arrays ``a`` and ``b`` both have at most ``n`` elements, and the report of the others:
    ``(n_rows, n_kept, n_discarded, n_long_a, n_long_b)`` counted in the same pass, for whoever runs an action on the rows
    first.  A row with a null array is discarded and counts as long in it."""
    long_a, long_b = (F.coalesce(F.size(F.col(c)) > n, F.lit(True)) | F.col(c).isNull() for c in (a, b))
    report = Observation(name)
    seen = df.withColumns({"_la": long_a, "_lb": long_b}).observe(
        report, F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("_la") & ~F.col("_lb")).alias("n_kept"),
        F.count_if(F.col("_la") | F.col("_lb")).alias("n_discarded"), F.count_if("_la").alias("n_long_a"), F.count_if("_lb").alias("n_long_b"))
    return seen.where(~F.col("_la") & ~F.col("_lb")).drop("_la", "_lb"), report


def repair_labels(df: DataFrame, line: str, label_index: int = 1, max_fields: int = 5) -> DataFrame:
    """TX13: split a CoNLL line, skip lines with more than ``max_fields`` fields,
    Cyrillic label -> ``O``, ``True`` -> ``1``."""
    keep = [c for c in df.columns if c != line]
    # One space at a time: a split at one character needs no pattern in each row.
    spaced = df.select(*keep, F.trim(F.regexp_replace(F.col(line), T.WS, " ")).alias("_line"))
    rows = spaced.select(*keep, F.when(F.col("_line") == "", F.array().cast("array<string>")).otherwise(F.split("_line", " ")).alias("_f"))
    # A row of each row: a filter on the fields themselves would be pushed down, where it makes the line and splits it again.
    one = F.struct(F.size("_f").alias("_n"), F.get(F.col("_f"), 0).alias("token"), F.get(F.col("_f"), label_index).alias("_label"))
    rows = rows.select(*keep, F.inline_outer(F.array(one))).where(F.col("_n") <= max_fields)
    return rows.select(*keep, "token", T.repair_label("_label").alias("label"))


def whitelist_tag(tag, types: Sequence[str]) -> Column:
    """TX14: tags outside ``{O, B-t, I-t}`` become ``O``."""
    keep = ["O"] + [p + t for t in types for p in ("B-", "I-")]
    tag = T._c(tag)
    return F.when(tag.isin(*keep), tag).otherwise(F.lit("O"))
