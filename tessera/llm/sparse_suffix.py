"""Repeated passages by sparse suffix arrays, and their removal.

Runs of words are kept at minimisers only: of every ``SPAN`` runs of ``GRAM`` words in a row, the one with the
smallest hash; so any ``LENGTH`` words in a row hold a kept run, the same in each copy.  Runs found once in
the corpus are dropped (counted with partial sums).  Of the documents with others, the suffixes that have a
kept run within their first ``LENGTH`` words are sorted to this depth over range partitions, by hash and then
by document: those that begin alike are one interval, and every one but its smallest document's repeats the
document before it in the interval.  An interval may lie in many partitions; only a partition's first suffix
needs another one, the last of the partition before, so these edges are sorted once more.  Overlapping
repeats join to passages.  A document keeps the words of which no smaller document has a window of
``LENGTH`` words around them, wherever partitions end.

Words are those between white space, A-Z lower-cased; runs and windows are compared by 64-bit hashes.  Defined results: a null or short text repeats nothing; rows of equal id and text are one
document, each row has its result; of an equal id the text decides the order; a null id is the smallest;
an empty table gives no rows.  A passage inside one document alone isn't a repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import discard, marked, marks, stored
from tessera.llm.words import SPACED, blocks, grams, words

LENGTH, GRAM = 50, 26
SPAN = LENGTH - GRAM + 1
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def minimisers(gram: np.ndarray, text: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Places of the smallest (the last of equals) of each ``span`` grams in a row of one text."""
    n = len(gram)
    if n < span:
        return np.zeros(0, np.int64)
    best, reach = np.arange(n), 1
    while reach < span:  # the smallest of doubling stretches
        step = min(reach, span - reach)
        a, b = best[:len(best) - step], best[step:]
        best = np.where(gram[b] <= gram[a], b, a)
        reach += step
    inside = text[:n - span + 1] == text[span - 1:]
    return np.unique(best[inside])


def _kept(block: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, text, place in the text) of the kept suffixes of a block."""
    w = words(block, SPACED)
    g = grams(w.hash, GRAM)
    text = w.text_of()
    whole = text[:len(g)] == text[GRAM - 1:] if len(g) else np.zeros(0, bool)
    place = np.flatnonzero(whole)
    at = place[minimisers(g[place], text[place])]
    return g[at], text[at], at - w.first[text[at]]


def _digest(block: list[bytes]) -> pa.Array:
    """128 bits of each text."""
    return pa.array([xxhash.xxh3_128_digest(t) for t in block], pa.binary())


def suffixes(docs: DataFrame) -> DataFrame:
    """(gram, id, own, pos) of the kept suffixes of (id, text); ``own`` tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, block in blocks(b.column(1)):
                g, text, pos = _kept(block)
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), b.column(0).slice(first, len(block)).take(at),
                                                  _digest(block).take(at), pa.array(pos, pa.int32())], names=["gram", "id", "own", "pos"])

    return docs.mapInArrow(run, "gram long, id long, own binary, pos int")


def _marked(df: DataFrame, key: str, bits: np.ndarray) -> DataFrame:
    """The rows whose ``key`` has a bit among the ``marks``."""
    shared, at = df.sparkSession.sparkContext.broadcast(bits), df.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(marked(shared.value, b.column(at))))

    return df.mapInArrow(run, df.schema)


def _packed(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(id, own, text) of the texts that have a bit among the ``marks``: the texts compressed."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            for first, block in blocks(b.column(1)):
                own = _digest(block)
                at = np.flatnonzero(marked(shared.value, own))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(block)).take(pa.array(at)), own.take(pa.array(at)),
                                                  pa.array([pack(block[k]) for k in at.tolist()], pa.binary())], names=["id", "own", "text"])

    return docs.mapInArrow(run, "id long, own binary, text binary")


def _windows(wanted: DataFrame, length: int) -> DataFrame:
    """(window, id, own, starts) for rows (id, own, text, places): the hash of each ``length`` words in a row that
    hold one of the places, and where they start in the text (32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for whole in batches:
            for x in range(0, whole.num_rows, 256):
                rows = whole.slice(x, 256)
                for first, block in blocks(pa.array([unpack(t) for t in rows.column(2).to_pylist()], pa.binary())):
                    b = rows.slice(first, len(block))
                    places = b.column(3).to_pylist()
                    w = words(block, SPACED)
                    text = np.repeat(np.arange(len(block)), [len(p) for p in places])
                    at = w.first[text] + np.array([y for p in places for y in p], np.int64)
                    low, high = np.maximum(at - (length - GRAM), w.first[text]), np.minimum(at, w.first[text + 1] - length) + 1
                    some = low < high
                    n = len(w.hash) + 1
                    inside = np.cumsum(np.bincount(low[some], minlength=n) - np.bincount(high[some], minlength=n))
                    start = np.flatnonzero(inside)
                    window, text = grams(w.hash, length)[start].view(np.int64), w.text_of()[start]
                    o = np.lexsort((start, window, text))
                    start, window, text = start[o], window[o], text[o]
                    new = np.flatnonzero(np.concatenate([[True], (np.diff(window) != 0) | (np.diff(text) != 0)])[:len(start)])
                    ends = np.append(new, len(start)).astype(np.int32) * 4
                    starts = pa.Array.from_buffers(pa.binary(), len(new), [None, *map(pa.py_buffer, (ends, (start - w.first[text]).astype("<i4")))])
                    row = pa.array(text[new])
                    yield pa.RecordBatch.from_arrays([pa.array(window[new]), b.column(0).take(row), b.column(1).take(row), starts], names=_ROW)

    return wanted.mapInArrow(run, "window long, id long, own binary, starts binary")


_ROW = ["window", "id", "own", "starts"]
REPEAT, FIRST, LAST = range(3)


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted partitions: the windows that the document before has too, with its id (REPEAT), and the FIRST and the
    LAST row."""
    before = None

    def out(kind: int, b: pa.RecordBatch, of: np.ndarray | None = None) -> pa.RecordBatch:
        n = b.num_rows
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *b.columns, pa.nulls(n, pa.int64()) if of is None else pa.array(of)],
                                          names=["kind", *_ROW, "of"])

    for b in batches:
        if not b.num_rows:
            continue
        if before is None:
            yield out(FIRST, b.slice(0, 1))
        else:
            b = pa.Table.from_batches([before, b]).combine_chunks().to_batches()[0]
        window, id_ = (b.column(c).to_numpy() for c in (0, 1))
        again = window[1:] == window[:-1]
        yield out(REPEAT, b.slice(1).filter(pa.array(again)), id_[:-1][again])
        before = b.slice(b.num_rows - 1)
    if before is not None:
        yield out(LAST, before)


_NULL = -(1 << 63)


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, own, spans): of each document with repeated passages, the disjoint spans of words (start, end) that
    are found in smaller ones, each with the ids of the next smaller documents that have its words."""
    if length < LENGTH:
        raise ValueError(f"passages of {length} words may hold no kept suffix")
    d = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL)).alias("id"), F.col(text).alias("text"))
    kept = stored(suffixes(d), "suffixes")
    often = stored(kept.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "often")  # so that a hot run's rows can be split
    places = stored(_marked(kept, "gram", marks(often, "gram")).join(often, "gram").groupBy("id", "own").agg(F.collect_set("pos").alias("places")), "places")
    discard(kept, often)
    wanted = _packed(d, marks(places, "own")).join(places, ["id", "own"]).select("id", "own", "text", "places").dropDuplicates(["id", "own"])
    order = ["window", "id", "own"]
    found = _windows(wanted, length).repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(found.mapInArrow(_told, "kind int, window long, id long, own binary, starts binary, of long"), "neighbours")
    discard(places)
    edges = found.where(F.col("kind") != REPEAT).groupBy(*order).agg(F.min("kind").alias("kind"), F.first("starts").alias("starts"))
    edges = edges.withColumn("of", F.lag("id").over(Window.partitionBy("window").orderBy("id", "own"))).where((F.col("kind") == FIRST) & F.col("of").isNotNull())
    spans = found.where(F.col("kind") == REPEAT).select("id", "own", "starts", "of").unionByName(edges.select("id", "own", "starts", "of"))
    name = F.when(F.col("id") != _NULL, F.col("id")).alias("id")
    return _joined(spans.groupBy("id", "own").agg(F.collect_list(F.struct("starts", "of")).alias("all")).select(name, "own", "all"), length)


def _joined(spans: DataFrame, length: int) -> DataFrame:
    """Overlapping and touching windows of a document as one span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for x in range(0, whole.num_rows, 256):
                b = whole.slice(x, 256)
                each, all_ = pc.list_value_length(b.column(2)).to_numpy(), b.column(2).flatten()
                starts = pc.struct_field(all_, 0)
                size = pc.binary_length(starts).to_numpy() // 4
                start = np.frombuffer(b"".join(starts.to_pylist()), "<i4").astype(np.int64)
                of = np.repeat(pc.struct_field(all_, 1).to_numpy(), size)
                doc = np.repeat(np.repeat(np.arange(b.num_rows), each), size)
                o = np.lexsort((start, doc))
                start, of, doc = start[o], of[o], doc[o]
                new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(start) > length)])
                at, span = np.flatnonzero(new), np.cumsum(new) - 1
                o = np.lexsort((of, span))
                other, where = of[o], span[o]
                once = np.concatenate([[True], (np.diff(where) != 0) | (other[1:] != other[:-1])])
                other, where = other[once], where[once]
                ids = pa.ListArray.from_arrays(pa.array(np.searchsorted(where, np.arange(len(at) + 1)), pa.int32()), pa.array(other, mask=other == _NULL))
                end = start[np.append(at[1:], len(start)) - 1] + length
                parts = pa.StructArray.from_arrays([pa.array(start[at]), pa.array(end), ids], names=["start", "end", "of"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[at], np.arange(b.num_rows + 1)), pa.int32()), parts)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["id", "own", "spans"])

    return spans.mapInArrow(run, "id long, own binary, spans array<struct<start:bigint,end:bigint,of:array<bigint>>>")


def cut(text: str, spans: list[dict]) -> str:
    """``text`` without the words of the spans; the white space after each of them goes too."""
    data = text.encode()
    starts = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    out, at = [], 0
    for s in spans:
        out.append(data[at:starts[s["start"]]])
        at = starts[s["end"]]
    return b"".join([*out, data[at:]]).decode()


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with its columns and without the repeated passages; documents of which no word is left go.

    The spans are written, so that the join with the texts knows their size; texts that surely have none stay
    where they are, the others are moved to the join.
    """
    spans = stored(repeats(docs, doc_id, text, length).select(F.col("id").alias("__ss_id"), F.col("own").alias("__ss_own"), F.col("spans").alias("__ss_spans")), "spans")
    at, names = docs.columns.index(text), [*docs.columns, "__ss_key"]
    shared = docs.sparkSession.sparkContext.broadcast(marks(spans, "__ss_own"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            for first, block in blocks(b.column(at)):
                own = _digest(block)
                some = np.flatnonzero(marked(shared.value, own))
                cols = b.slice(first, len(block)).take(pa.array(some)).columns
                there = cols[at].is_valid().to_pylist()
                cols[at] = pa.array([pack(block[k]) if v else None for k, v in zip(some.tolist(), there)], pa.binary())
                yield pa.RecordBatch.from_arrays([*cols, own.take(pa.array(some))], names=names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, block in blocks(b.column(at)):
                yield b.slice(first, len(block)).filter(pa.array(~marked(shared.value, _digest(block))))

    fields = [f"`{c}` {'binary' if c == text else t}" for c, t in docs.dtypes]  # the texts are compressed on their way
    keyed = docs.mapInArrow(digest, ", ".join([*fields, "`__ss_key` binary"]))
    rows = keyed.join(spans, keyed[doc_id].cast("long").eqNullSafe(spans["__ss_id"]) & (keyed["__ss_key"] == spans["__ss_own"]), "left")
    rows = rows.select(*docs.columns, "__ss_spans")

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for rows in batches:
            for x in range(0, rows.num_rows, 512):
                b = rows.slice(x, 512)
                cols, spans_of = list(b.columns[:-1]), b.column(len(names) - 1).to_pylist()
                texts = [None if t is None else unpack(t).decode() for t in cols[at].to_pylist()]
                texts = [cut(t, s) if s else t for t, s in zip(texts, spans_of)]
                cols[at] = pa.array(texts, pa.string())
                left = pa.array([not s or bool(_WORD.search(t.encode())) for t, s in zip(texts, spans_of)])
                yield pa.RecordBatch.from_arrays(cols, names=names[:-1]).filter(left)

    return docs.mapInArrow(whole, docs.schema).unionAll(rows.mapInArrow(shorten, docs.schema))
