"""Dictionary encoding of a corpus (AG9 ids for TX25): every distinct word gets a dense id, texts become id arrays.

Ids follow frequency (count descending, then word) or name order, after the reserved ids.  Words are ranked over
range partitions (``splits.ordinal``), never in one task.  Encoding resolves the ``HOT`` most frequent words inside a
text's row, by a table of that many entries that every task has.  The other tokens are rows that meet the vocabulary in a
join by word, and none of those words holds more than one token in ``HOT`` of the corpus; a text's resolved tokens stay
one array.  So no task gets a hot word, most tokens are never rows, and texts are read once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.splits import ordinal
from tessera.session import scratch_path

PAD, UNKNOWN, RESERVED = 0, 1, 2
#: Words that are looked up inside rows: the size of that table, whatever the corpus.
HOT = 65_536


def word_counts(df: DataFrame, toks: str) -> DataFrame:
    """``(word, n)`` over all rows."""
    return df.select(F.explode(toks).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(counts: DataFrame, by: str = "frequency", reserved: int = RESERVED) -> DataFrame:
    """AG9 for any number of words: ``(word, n, id)`` from ``(word, n)``, written once to the shared folder."""
    ranked = counts.select("word", "n", (-F.col("n")).alias("_less"))
    ranked = ordinal(ranked, "_less", tiebreak=["word"]) if by == "frequency" else ordinal(ranked, "word")
    path = scratch_path(counts.sparkSession, "vocabulary")
    ranked.select("word", "n", (F.col("ordinal") + (reserved - 1)).alias("id")).write.parquet(path)
    return counts.sparkSession.read.parquet(path)


def _hottest(vocab: DataFrame, hot: int) -> DataFrame:
    """The ``hot`` most frequent words: a top-k, whatever the order of the ids."""
    return vocab.orderBy(F.desc("n"), "word").limit(hot)


def _resolved(source: pa.Array, target: pa.Array) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, array) -> (key, targets of the elements in ``source``, else null; places and elements of the others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(1)
            flat, sizes = items.flatten(), pc.fill_null(pc.list_value_length(items), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
            known = flat.cast(source.type)
            index = pc.index_in(known, value_set=source) if len(source) else pa.nulls(len(flat), pa.int32())
            rest = np.flatnonzero(index.is_null().to_numpy(zero_copy_only=False))
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            rest_offsets = pa.array(np.concatenate([[0], np.searchsorted(rest, ends)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.ListArray.from_arrays(offsets, target.take(index)),
                pa.ListArray.from_arrays(rest_offsets, pa.array(place[rest].astype(np.int32))),
                pa.ListArray.from_arrays(rest_offsets, known.take(pa.array(rest)))], ["key", "found", "at", "rest"])

    return run


def _mapped(df: DataFrame, key: str, arr: str, out: str, vocab: DataFrame, source: str, target: str, missing: Column, hot: int) -> DataFrame:
    """``out``: each element of ``arr`` looked up in ``vocab`` from ``source`` to ``target``, in its place."""
    some = _hottest(vocab, hot).select(source, target).toArrow()
    of = {c: vocab.schema[c].dataType.simpleString() for c in (source, target)}
    key_type = df.schema[key].dataType.simpleString()
    known = df.select(F.col(key).alias("key"), arr).mapInArrow(
        _resolved(some.column(source).combine_chunks(), some.column(target).combine_chunks()),
        f"key {key_type}, found array<{of[target]}>, at array<int>, rest array<{of[source]}>")
    # One pass: a row with the resolved elements of each text, and one for each of the others.
    parts = F.concat(F.array(F.struct("found", F.lit(None).cast("int").alias("_pos"), F.lit(None).cast(of[source]).alias("_item"))),
                     F.zip_with("at", "rest", lambda p, x: F.struct(F.lit(None).cast(f"array<{of[target]}>").alias("found"), p.alias("_pos"), x.alias("_item"))))
    rows = known.select(F.col("key").alias(key), F.inline(parts))
    # Rows without an element keep no join key: they are dealt out, so they don't meet in one task.
    spread = F.when(F.col("_item").isNull(), F.pmod(F.xxhash64(key, "_pos"), F.lit(4096)).cast("int")).otherwise(F.lit(-1))
    rare = vocab.select(F.col(source).alias("_item"), F.col(target).alias("_rare"), F.lit(-1).alias("_deal"))
    found = rows.withColumn("_deal", spread).join(rare, ["_item", "_deal"], "left")
    other = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("_rare", missing).alias("v")))
    g = found.groupBy(key).agg(F.collect_list("found").alias("_found"), F.collect_list(other).alias("_others"))
    placed = F.flatten(F.transform("_found", lambda a: F.filter(F.transform(a, lambda v, i: F.struct(i.alias("_pos"), v.alias("v"))), lambda x: x["v"].isNotNull())))
    return g.select(key, F.array_sort(F.concat(placed, "_others")).alias("_items")).select(key, F.transform("_items", lambda x: x["v"]).alias(out))


def encode(df: DataFrame, key: str, toks: str, vocab: DataFrame, out: str = "ids", hot: int = HOT) -> DataFrame:
    """``(key, ids)``: the words' ids in order, ``UNKNOWN`` for words outside the vocabulary; a row without words gets
    an empty array.  ``key`` is unique."""
    return _mapped(df, key, toks, out, vocab, "word", "id", F.lit(UNKNOWN).cast("long"), hot)


def decode(df: DataFrame, key: str, ids: str, vocab: DataFrame, out: str = "words", hot: int = HOT) -> DataFrame:
    """``(key, words)``: the inverse of ``encode``; reserved and unknown ids give null."""
    return _mapped(df, key, ids, out, vocab, "id", "word", F.lit(None).cast("string"), hot)
