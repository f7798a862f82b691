"""TX23: split a phrase into (quantity, rest) — re-aimed.

The reference decides what a number is from a morphological analyser's tags;
here a number token is an all-digit token, a number word from the fixed date
lists (cardinals, ordinals) or ``несколько``.  The text rewriting around it
(thousand words, digit groups, commas between digits, symbol stripping, unit
words, trailing ``-``) follows the reference.  All steps are built-in
expressions on one row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import WS, _c
from tessera.operators.dates import NUMBERS, ORDINALS

# Thousand words, symbols stripped from tokens, unit tokens that
# end a phrase, and unit words dropped from the rest.
THOUSANDS = ("тысяч", "тыс", "тысячи", "тыc.")
EXCL_SYMS = ("●.,€¶№%£♫♪░▒▓♫$│♪╖╣║╕╗╝┤╡╢▸╛�®‰™⏰⌚⌛⏳©¬³°¯²§±‡†¾½¼µ☒☐•!\\#&\\()\u0093\u0094*+,/:;<=>?[\\\\]^_`{|}~’‘«»…")
EXCL_TOKS = ("шт", "ед", "eд", "ЕД", "EД")
UNIT_WORDS = ("единиц", "eдиниц", "единицами", "единицы", "ед", "ЕД")
FEW = "несколько"

DIGIT_COMMA = "\\p{Nd},\\p{Nd}"
COMMA_BETWEEN = "(\\p{Nd}),(\\p{Nd})"
NUM_TOKEN = "^\\p{Nd}+$"


def _split(c: Column) -> Column:
    return F.filter(F.split(c, WS), lambda x: x != "")


def _drop_digit_commas(c: Column) -> Column:
    # Two non-overlapping passes remove every comma between two digits (what a
    # look-around pattern does in one pass).
    return F.regexp_replace(F.regexp_replace(c, COMMA_BETWEEN, "$1$2"), COMMA_BETWEEN, "$1$2")


def _strip_prefix(t: Column, prefix: str, extra: int) -> Column:
    return F.when(t.startswith(prefix) & (F.length(t) > len(prefix) + extra),
                  F.replace(t, F.lit(prefix), F.lit(""))).otherwise(t)


def quantity_parts(text) -> Column:
    """``struct(number, rest)`` for one phrase; no number -> ``('1', phrase)``."""
    toks = _split(_c(text))
    prev = F.slice(F.concat(F.array(F.lit(None).cast("string")), toks), 1, F.size(toks))
    nxt = F.slice(toks, 2, F.greatest(F.size(toks) - 1, F.lit(0)))
    trip = F.zip_with(F.zip_with(toks, prev, lambda x, p: F.struct(x.alias("x"), p.alias("p"))), nxt,
                      lambda s, n: F.struct(s["x"].alias("x"), s["p"].alias("p"), n.alias("n")))

    def rewrite(s):
        x, p, n = s["x"], s["p"], s["n"]
        in_t = x.isin(*THOUSANDS)
        return (F.when(in_t & F.coalesce(p.rlike(DIGIT_COMMA), F.lit(False)), F.lit("00"))
                .when(in_t, F.lit("000"))
                .when(x.rlike(DIGIT_COMMA) & F.coalesce(n.isin(*THOUSANDS), F.lit(False)), _drop_digit_commas(x))
                .otherwise(x))
    joined = F.array_join(F.transform(trip, rewrite), " ")
    joined = _drop_digit_commas(F.regexp_replace(joined, "(\\p{Nd}) +(\\p{Nd})", "$1$2"))
    t2 = F.transform(_split(joined), lambda t: F.translate(
        _strip_prefix(_strip_prefix(_strip_prefix(t, "ед.", 1), "eд.", 1), "единиц", 3), EXCL_SYMS, ""))
    return t2


def _is_num(t: Column) -> Column:
    return t.rlike(NUM_TOKEN) | t.isin(*NUMBERS) | t.isin(*ORDINALS) | (t == FEW)


def extract_quantity(df, text: str, toks_col: str = "_qt"):
    """TX23 as a DataFrame step: adds ``number`` and ``rest``."""
    d = df.withColumn(toks_col, quantity_parts(text))
    t = F.col(toks_col)
    n = F.size(t)
    ind = F.array_position(F.transform(t, _is_num), True).cast("int")  # 1-based, 0 when none
    last_unit = F.coalesce(F.try_element_at(t, F.lit(-1)).isin(*EXCL_TOKS), F.lit(False))
    last_two_num = F.coalesce(F.get(t, n - 1).rlike(NUM_TOKEN), F.lit(False)) | \
        F.coalesce(F.get(t, n - 2).rlike(NUM_TOKEN), F.lit(False))
    no_units = F.filter(t, lambda x: ~x.isin(*EXCL_TOKS))
    rest_a = F.array_join(F.slice(no_units, 1, F.greatest(F.size(no_units) - 1, F.lit(0))), " ")
    no_unit_words = F.filter(t, lambda x: ~x.isin(*UNIT_WORDS))
    rest_b = F.array_join(F.slice(no_unit_words, ind + 1, F.greatest(F.size(no_unit_words) - ind, F.lit(0))), " ")
    num_b = F.lower(F.array_join(F.slice(t, 1, F.greatest(ind, F.lit(1))), " "))
    dash = lambda s: F.when(s.endswith("-"), F.trim(F.substring(s, 1, F.length(s) - 1))).otherwise(s)
    number = (F.when(ind == 0, F.lit("1")).when(last_unit, F.lower(F.try_element_at(t, ind)))
              .when(~last_two_num | (n <= 4), num_b).otherwise(F.lit("1")))
    rest = (F.when(ind == 0, F.array_join(t, " ")).when(last_unit, dash(rest_a))
            .when(~last_two_num | (n <= 4), dash(rest_b)).otherwise(F.array_join(t, " ")))
    return d.withColumn("number", number).withColumn("rest", rest).drop(toks_col)
