"""Column -> Column text functions (tokenising, cleaning, cutting).

Everything here is a built-in Spark expression (regex, higher-order array
functions), so it stays inside whole-stage codegen and runs per row with no
shuffle.  Java regex differs from Python's: ``\\s``/``\\w`` are ASCII unless
``(?U)``; the classes below are spelled out so that Python's Unicode meaning is
kept and so that RE2 (the SQL oracle) reads them the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's Unicode ``\s`` / ``\w``.
WS = "(?U)\\s+"
WORD_CLASS = "[\\p{L}\\p{N}_]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c, lower: bool = True) -> Column:
    """Rule T: whitespace tokens, lower-cased by default, empties dropped."""
    c = _c(c)
    if lower:
        c = F.lower(c)
    return F.filter(F.split(c, WS), lambda x: x != "")


def clean_string(c) -> Column:
    """TX1: newline/tab -> space, collapse whitespace runs, strip."""
    return F.trim(F.regexp_replace(_c(c), WS, " "))


def first_n_tokens(c, n: int = 300) -> Column:
    """TX2: whitespace-normalise, keep the first ``n`` tokens, re-join."""
    norm = clean_string(c)
    return F.array_join(F.slice(F.split(norm, " "), 1, n), " ")


def clean_tweet(c) -> Column:
    """TX3: drop ``$ticker``, a leading ``RT``, URLs up to the end of the line, ``#``."""
    c = _c(c)
    c = F.regexp_replace(c, "\\$" + WORD_CLASS + "*", "")
    c = F.regexp_replace(c, "^RT(?U)\\s+", "")
    # (?d): only \n ends a line for ``.``, as in Python.
    c = F.regexp_replace(c, "(?d)https?://.*[\\r\\n]*", "")
    return F.regexp_replace(c, "#", "")


# Python's ``string.punctuation``.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def not_punctuation(tok: Column) -> Column:
    """TX4 punctuation test: a token goes when it is a substring of the set."""
    return F.instr(F.lit(ASCII_PUNCTUATION), tok) == 0


def cut_at_marker(c, marker: str = "</s>", keep_marker: bool = True) -> Column:
    """TX16: cut decoded text at an end marker.

    ``keep_marker`` keeps the text up to and including the marker (``find+4``);
    otherwise the cut falls one character before the marker (``find-1``), as the
    ``[SEP]`` variant does.  No marker: text unchanged.
    """
    c = _c(c)
    pos = F.instr(c, marker)
    if keep_marker:
        cut = F.substring(c, F.lit(1), pos + len(marker) - 1)
    else:
        cut = F.substring(c, F.lit(1), F.greatest(pos - 2, F.lit(0)))
    return F.when(pos > 0, cut).otherwise(c)


def is_cyrillic(c) -> Column:
    """TX12: any character in U+0410..U+044F (Ё/ё are outside the range)."""
    return _c(c).rlike("[\\x{0410}-\\x{044F}]")


def repair_label(c) -> Column:
    """TX13: a label with Cyrillic letters becomes ``O``, ``True`` in a label becomes ``1``."""
    c = _c(c)
    return F.when(is_cyrillic(c), F.lit("O")).otherwise(F.replace(c, F.lit("True"), F.lit("1")))


def markup_line_clean(c) -> Column:
    """TX10: ``line.split('>')[-2].split('<')[0]``; short lines give NULL."""
    parts = F.split(_c(c), ">")
    second_last = F.try_element_at(parts, F.lit(-2))
    return F.split_part(second_last, F.lit("<"), F.lit(1))


def quote(c) -> Column:
    """Percent-encoding with Python ``quote`` rules: space -> ``%20``, ``/`` and
    ``~`` kept, ``*`` encoded (Java's encoder differs on exactly these)."""
    e = F.url_encode(_c(c))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return e


def term_url(c, base: str) -> Column:
    """TX21: base URL + percent-encoded term."""
    return F.concat(F.lit(base), quote(c))


def form_class(first_form, third_form) -> Column:
    """TX22: ``len(f3)<=3`` -> infinitive; else ``len(f1)<=3`` -> impersonal; else personal."""
    return (F.when(F.length(_c(third_form)) <= 3, F.lit("infinitive"))
            .when(F.length(_c(first_form)) <= 3, F.lit("impersonal"))
            .otherwise(F.lit("personal")))


def limit_ok(a, b, n: int = 512) -> Column:
    """TX15 predicate: both token arrays within ``n``."""
    return (F.size(_c(a)) <= n) & (F.size(_c(b)) <= n)


def mask_pad(ids, size) -> Column:
    """TX24: the places from ``size`` on, where padding stands, become -100; a real id is never masked."""
    return F.transform(_c(ids), lambda x, i: F.when(i >= size, F.lit(-100)).otherwise(x))


def fixed_length(ids, n: int, pad_id: int = 0) -> Column:
    """TX25: truncate or pad to ``n``."""
    ids = _c(ids)
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad_id), n)), 1, n)


def attention_mask(ids, n: int) -> Column:
    """TX25 mask: 1 for real positions, 0 for padding."""
    size = F.size(_c(ids))
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: (i <= size).cast("int"))


def word_pieces(c) -> Column:
    """Punctuation-aware tokens with explicit classes (same in Java and RE2)."""
    return F.regexp_extract_all(_c(c), F.lit("[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]"), 0)


# HTML entities decoded by the page-text extractor (``&amp;`` last).
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
                 ("&nbsp;", " "), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&mdash;", "\u2014"),
                 ("&ndash;", "\u2013"), ("&hellip;", "\u2026"), ("&reg;", "\u00ae"), ("&trade;", "\u2122"),
                 ("&amp;", "&"))

# Markup removed before tags are stripped.
HTML_DROP = ("(?is)<script\\b[^>]*>.*?</script\\s*>", "(?is)<style\\b[^>]*>.*?</style\\s*>",
             "(?s)<!--.*?-->", "(?i)<!doctype[^>]*>")
HTML_TAG = "</?[A-Za-z][^>]*>"


def _character(ref: Column) -> Column:
    """The character of a numeric reference; one beyond Unicode, a surrogate or 0 is U+FFFD, as HTML has it."""
    digits = F.regexp_extract(ref, "^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
    number = F.when(ref.rlike("^&#[xX]"), F.conv(F.right(digits, F.lit(12)), 16, 10)).otherwise(F.right(digits, F.lit(12))).try_cast("bigint")
    good = (F.length(digits) <= 7) & (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(F.coalesce(good, F.lit(False)), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise("\ufffd")


def numeric_references(c) -> Column:
    """Decimal and hexadecimal character references decoded; each distinct one is replaced once."""
    c = _c(c)
    refs = F.array_distinct(F.regexp_extract_all(c, F.lit("&#(?:[0-9]+|[xX][0-9a-fA-F]+);"), 0))
    return F.when(c.contains("&#"), F.aggregate(refs, c, lambda acc, r: F.replace(acc, r, _character(r)))).otherwise(c)


def html_entities(c) -> Column:
    """Numeric references, then the named ones of ``HTML_ENTITIES``."""
    h = numeric_references(c)
    for a, b in HTML_ENTITIES:
        h = F.replace(h, F.lit(a), F.lit(b))
    return h


def html_text(c) -> Column:
    """TX17 text: drop script/style/comments/doctype, remove tags (strings are
    joined with no separator, as a parser's ``get_text`` does), decode entities."""
    h = _c(c)
    for pat in HTML_DROP:
        h = F.regexp_replace(h, pat, "")
    return html_entities(F.regexp_replace(h, HTML_TAG, ""))


def html_blocks(c, block_tag: str = "ul") -> Column:
    """Inner markup of every ``<block_tag>`` element (TX18 tables/lists)."""
    return F.regexp_extract_all(_c(c), F.lit(f"(?s)<{block_tag}\\b[^>]*>(.*?)</{block_tag}>"), 1)


def html_cells(block, cell_tag: str = "li") -> Column:
    """Cells of one block as text (tags removed, whitespace normalised)."""
    cells = F.regexp_extract_all(block, F.lit(f"(?s)<{cell_tag}\\b[^>]*>(.*?)</{cell_tag}>"), 1)
    return F.transform(cells, lambda x: clean_string(F.regexp_replace(x, HTML_TAG, "")))


def html_tables(c) -> Column:
    """TX18: every table of a page as rows of cell texts, ``array<array<array<string>>>``; ``th`` and ``td`` are cells,
    their tags are removed and entities decoded.  The n-th table is ``get(html_tables(c), n)``.  A table inside a
    table's cell isn't told apart."""
    def inner(markup: Column, tag: str) -> Column:
        return F.regexp_extract_all(markup, F.lit(f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>"), 1)

    cell = lambda x: clean_string(html_entities(F.regexp_replace(x, HTML_TAG, "")))
    return F.transform(inner(_c(c), "table"), lambda t: F.transform(inner(t, "tr"), lambda r: F.transform(
        F.regexp_extract_all(r, F.lit("(?is)<t([dh])\\b[^>]*>(.*?)</t\\1\\s*>"), 2), cell)))
