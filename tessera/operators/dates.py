"""Dates written in words -> ISO dates (JN4, SF12) via nearest-word lookup (JN3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import _c

# Russian month names, ordinal and cardinal day numbers (1..31),
# in calendar order.
MONTHS = ("январь", "февраль", "март", "апрель", "май", "июнь", "июль", "август", "сентябрь", "октябрь",
          "ноябрь", "декабрь")
ORDINALS = ("первый", "второй", "третий", "четвертый", "пятый", "шестой", "седьмой", "восьмой", "девятый",
            "десятый", "одиннадцатый", "двенадцатый", "тринадцатый", "четырнадцатый", "пятнадцатый",
            "шестнадцатый", "семнадцатый", "восемнадцатый", "девятнадцатый", "двадцатый", "двадцать первый",
            "двадцать второй", "двадцать третий", "двадцать четвертый", "двадцать пятый", "двадцать шестой",
            "двадцать седьмой", "двадцать восьмой", "двадцать девятый", "тридцатый", "тридцать первый")
NUMBERS = ("один", "два", "три", "четыре", "пять", "шесть", "семь", "восемь", "девять", "десять",
           "одиннадцать", "двенадцать", "тринадцать", "четырнадцать", "пятнадцать", "шестнадцать",
           "семнадцать", "восемнадцать", "девятнадцать", "двадцать", "двадцать один", "двадцать два",
           "двадцать три", "двадцать четыре", "двадцать пять", "двадцать шесть", "двадцать семь",
           "двадцать восемь", "двадцать девять", "тридцать", "тридцать один")

INVALID = "Invalid date"


def nearest_index(word, *lists) -> Column:
    """1-based position of the closest entry (Levenshtein) over ``lists`` in
    order; ties keep the earlier list, then the earlier position."""
    entries = [(li, pos, w) for li, words in enumerate(lists) for pos, w in enumerate(words)]
    arr = F.array(*[F.struct(F.lit(li).alias("l"), F.lit(pos).alias("p"), F.lit(w).alias("w")) for li, pos, w in entries])
    w = _c(word)
    best = F.array_min(F.transform(arr, lambda e: F.struct(F.levenshtein(w, e["w"]).alias("d"), e["l"].alias("l"),
                                                             e["p"].alias("p"))))
    return best["p"] + 1


def part_number(part, *lists) -> Column:
    """A date part: digits pass through, words go through the nearest lookup."""
    p = F.trim(_c(part).cast("string"))
    if not lists:
        return F.when(p.rlike("^[0-9]+$"), p.cast("int"))
    return F.when(p.rlike("^[0-9]+$"), p.cast("int")).otherwise(nearest_index(F.lower(p), *lists))


def words_to_date(year, month, day) -> Column:
    """JN4 + SF12: ``yyyy-MM-dd`` or ``Invalid date`` for impossible dates."""
    y = part_number(year)
    m = part_number(month, MONTHS)
    d = part_number(day, ORDINALS, NUMBERS)
    s = F.format_string("%04d-%02d-%02d", y, m, d)
    dt = F.try_to_date(s, "yyyy-MM-dd")
    return F.when(dt.isNull(), F.lit(INVALID)).otherwise(F.date_format(dt, "yyyy-MM-dd"))


def strict_date(s) -> Column:
    """SF12: a ``yyyy-MM-dd`` string checked for existence (NULL when invalid)."""
    return F.try_to_date(_c(s), "yyyy-MM-dd")


def words_to_dates(df, year: str, month: str, day: str, out: str = "date"):
    """DataFrame form of ``words_to_date``: the nearest-word lookups run once per
    distinct month word and day word (a vocabulary, far smaller than the rows)
    and are joined back on the word; the rows never meet the lists."""
    mw = df.select(F.col(month).alias("_mw")).distinct().withColumn("_m", part_number(F.col("_mw"), MONTHS))
    dw = df.select(F.col(day).alias("_dw")).distinct().withColumn("_d", part_number(F.col("_dw"), ORDINALS, NUMBERS))
    j = (df.join(mw, df[month].eqNullSafe(mw["_mw"]), "left")
         .join(dw, df[day].eqNullSafe(dw["_dw"]), "left"))
    s = F.format_string("%04d-%02d-%02d", part_number(F.col(year)), F.col("_m"), F.col("_d"))
    dt = F.try_to_date(s, "yyyy-MM-dd")
    return j.withColumn(out, F.when(dt.isNull(), F.lit(INVALID)).otherwise(F.date_format(dt, "yyyy-MM-dd"))).drop(
        "_mw", "_m", "_dw", "_d")
