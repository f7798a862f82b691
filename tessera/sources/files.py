"""CSV, line lists, whole files and split writers (IO3-IO7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_labelled_csv(spark: SparkSession, path: str, schema: str, header: bool = False,
                      newlines: bool = True) -> DataFrame:
    """IO3: CSV with a declared column order; quoted fields may hold commas and quotes (doubled).

    ``newlines``: quoted fields may also hold newlines; then a file can't be split and is read by one task.
    Turn it off for large files without such fields."""
    return (spark.read.schema(schema).option("header", header).option("quote", '"').option("escape", '"')
            .option("multiLine", newlines).csv(path))


def write_labelled_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).option("quote", '"').option("escape", '"').csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """IO4: a line list, stripped of all white space, as ``(line, file, place)``; ``place`` ascends in file
    order, with gaps between the parts in which a file is read."""
    raw = spark.read.text(path)
    return raw.select(F.regexp_replace("value", "(?U)^\\s+|\\s+$", "").alias("line"), F.col("_metadata.file_path").alias("file"),
                      F.monotonically_increasing_id().alias("place"))


def _language_of(path) -> Column:
    """The language of a list file: its folder's ``lang=`` value, or else its name up to the first dot."""
    folder = F.regexp_extract(path, "/lang=([^/]+)/", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, "([^/.]+)[^/]*$", 1))


def read_word_lists(spark: SparkSession, path: str) -> DataFrame:
    """IO6: word lists, one word per line and one file (``<language>.txt``) or folder (``lang=<language>``) per
    language, as ``(lang, word)``; blank lines and repeats go."""
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    word = F.regexp_replace("value", "(?U)^\\s+|\\s+$", "")
    return raw.select(_language_of(F.col("_metadata.file_path")).alias("lang"), word.alias("word")).where(F.col("word") != "").distinct()


def read_lemmas(spark: SparkSession, path: str) -> DataFrame:
    """IO6: lemma lists of the same layout with lines ``form <tab> lemma``, as ``(lang, form, lemma)``; of several
    lemmas of a form the first by name counts, and lines without a tab are no entries."""
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    parts = F.split("value", "\t")
    rows = raw.select(_language_of(F.col("_metadata.file_path")).alias("lang"), F.trim(parts[0]).alias("form"), F.trim(F.get(parts, 1)).alias("lemma"))
    return rows.where((F.col("form") != "") & (F.col("lemma") != "")).groupBy("lang", "form").agg(F.min("lemma").alias("lemma"))


def write_word_lists(df: DataFrame, path: str, value: str = "word", lang: str = "lang") -> None:
    """IO7: a folder of line files per language."""
    df.select(F.col(lang).alias("lang"), F.col(value).alias("value")).write.mode("overwrite").partitionBy("lang").text(path)


def write_json_stats(df: DataFrame, path: str) -> None:
    """IO7: statistics as one JSON object per line; a handful of rows, so one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """IO5: every file of a folder as ``(path, text)`` (UTF-8)."""
    raw = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", split: str = "split") -> None:
    """IO7: one folder per split value."""
    df.write.mode("overwrite").partitionBy(split).format(fmt).save(path)
