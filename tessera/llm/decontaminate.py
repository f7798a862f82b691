"""Benchmark decontamination with suffix arrays over the training texts.

Each shard of training texts (a run of whole texts) gets a suffix array over its words, sorted to the
depth of a window.  Every suffix of every benchmark item is looked up by binary search; neighbouring hits
on one diagonal are joined to the longest verbatim matches, whose places are kept.  Texts stay in their
tasks: no row is shuffled.  The benchmark is read in blocks of ``BLOCK_BYTES``; each block is broadcast by
itself, and if there are several, the documents with their hits so far are written between the passes.

Words are compared as 64-bit hashes.  Defined results: a null or empty text or item has no words and no
hits; an item of fewer words than a window is one window; items with a null id make hits, but aren't
named; repeated items count once; repeated documents are judged row by row; an empty benchmark hits
nothing; an empty table gives no rows.  Columns named like a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import stored
from tessera.llm.words import ALPHANUMERIC, blocks, grams, words

WINDOW = 10
#: Bytes of benchmark text that are broadcast at once, and of training text in one suffix array.
BLOCK_BYTES = 8_000_000
SHARD_BYTES = 4_000_000
RESULTS = ("n_words", "hits", "items", "matches")
_LOW = np.uint64(0xFFFFFFFF)
_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_MATCHES = pa.list_(pa.struct([("item_id", pa.int64()), ("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())]))


class SuffixArray:
    """Positions of a word sequence, sorted by the ``depth`` words that begin there."""

    def __init__(self, hashes: np.ndarray, depth: int):
        self.high = np.concatenate([hashes >> np.uint64(32), np.zeros(depth + 2, np.uint64)])
        n = len(hashes)
        first = self.high[:n] << np.uint64(32) | self.high[1:n + 1]
        self.order = order = np.argsort(first)
        at, group, same = np.arange(n), np.zeros(n, np.int64), np.diff(first[order]) == 0
        for s in range(2, depth + 1, 2):
            tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same])) if n else at
            group = np.cumsum(np.concatenate([[True], ~same]))[tied] if n else group
            at = at[tied]
            if s >= depth or not at.size:
                break
            key = self.key(order[at], s)
            o = np.lexsort((key, group))
            order[at], key = order[at][o], key[o]
            same = (np.diff(key) == 0) & (np.diff(group) == 0)

    def key(self, position: np.ndarray, s: int) -> np.ndarray:
        """The words s and s + 1 after each position, as one number that sorts like both."""
        return self.high[position + s] << np.uint64(32) | self.high[position + s + 1]

    def _bisect(self, lo: np.ndarray, hi: np.ndarray, s: int, want: np.ndarray, right: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while (open_ := np.flatnonzero(lo < hi)).size:
            mid = lo[open_] + hi[open_] >> 1
            key = self.key(self.order[mid], s)
            up = key <= want[open_] if right else key < want[open_]
            lo[open_[up]] = mid[up] + 1
            hi[open_[~up]] = mid[~up]
        return lo

    def find(self, high: np.ndarray, position: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of ``order`` that begin with the ``length`` words of another sequence at each position."""
        lo, hi = np.zeros(len(position), np.int64), np.full(len(position), len(self.order), np.int64)
        for s in range(0, int(length.max(initial=0)), 2):
            on = np.flatnonzero((length > s) & (lo < hi))
            key = high[position[on] + s] << np.uint64(32) | high[position[on] + s + 1]
            half = length[on] < s + 2
            low, top = np.where(half, key & ~_LOW, key), np.where(half, key | _LOW, key)
            lo[on], hi[on] = self._bisect(lo[on], hi[on], s, low, False), self._bisect(lo[on], hi[on], s, top, True)
        return lo, hi


@dataclass
class Tests:
    """A block of benchmark items: the word hashes, and each window's place, length, item and own place in it."""

    hashes: np.ndarray
    at: np.ndarray
    length: np.ndarray
    item: np.ndarray
    inside: np.ndarray
    gram: np.ndarray
    ids: list[int | None]

    @classmethod
    def of(cls, ids: list[int | None], texts: list[str | None], window: int) -> Tests:
        w = words(texts, ALPHANUMERIC)
        n = w.counts()
        many = np.where(n == 0, 0, np.maximum(n - window + 1, 1))
        item = np.repeat(np.arange(len(n)), many)
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        at, length = w.first[item] + inside, np.minimum(n, window)[item]
        gram = np.zeros(len(at), np.uint64)
        for k in np.unique(length):
            gram[length == k] = grams(w.hash, int(k))[at[length == k]]
        return cls(np.concatenate([w.hash, np.zeros(window + 2, np.uint64)]), at, length, item, inside, gram, ids)


def search(texts: list[bytes], tests: Tests, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each hit, place of the hit's first word in it, window of the hit)."""
    w = words(texts, ALPHANUMERIC)
    texts_of = w.text_of()
    place = np.arange(len(w.hash)) + texts_of * window  # gaps of no word between texts: no match reaches over them
    line = np.zeros(len(w.hash) + len(texts) * window, np.uint64)
    line[place] = w.hash
    array = SuffixArray(line, window)
    lo, hi = array.find(tests.hashes >> np.uint64(32), tests.at, tests.length)
    many = hi - lo
    test = np.repeat(np.arange(len(many)), many)
    hit = array.order[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + lo[test]]
    right = np.zeros(len(hit), bool)  # sorted by half of each hash: compare the whole
    for k in np.unique(tests.length[test]):
        own = np.flatnonzero(tests.length[test] == k)
        right[own] = grams(line, int(k))[hit[own]] == tests.gram[test[own]]
    hit, test = hit[right], test[right]
    text = np.searchsorted(w.first + np.arange(len(w.first)) * window, hit, side="right") - 1
    return w.counts(), text, hit - text * window - w.first[text], test


def _union(spans: np.ndarray) -> list[dict]:
    """Disjoint spans that cover the same words, in order."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    ends = np.concatenate([reach[:-1][new[1:]], reach[-1:]])
    return [{"start": a, "end": b} for a, b in zip(spans[new, 0].tolist(), ends.tolist())]


def _longest(start: np.ndarray, test: np.ndarray, tests: Tests) -> list[dict]:
    """The longest match of each item in one text: hits one after another on a diagonal are one match."""
    item, inside = tests.item[test], tests.inside[test]
    o = np.lexsort((start, start - inside, item))
    start, inside, item, length = start[o], inside[o], item[o], tests.length[test][o]
    new = np.concatenate([[True], (np.diff(item) != 0) | (np.diff(start - inside) != 0) | (np.diff(start) != 1)])
    first = np.flatnonzero(new)
    size = np.diff(np.concatenate([first, [len(start)]])) - 1 + length[first]
    best: dict[int, dict] = {}
    for f, n in zip(first.tolist(), size.tolist()):
        name = tests.ids[item[f]]
        if name is not None and (name not in best or n > best[name]["length"]):
            best[name] = {"item_id": name, "doc_start": int(start[f]), "item_start": int(inside[f]), "length": n}
    return sorted(best.values(), key=lambda m: m["item_id"])


def _pass(docs: DataFrame, text: str, tests, window: int, shard_bytes: int) -> DataFrame:
    """Adds the hits of one block of items to the result columns."""
    at, names = docs.columns.index(text), docs.columns
    place = {c: names.index(c) for c in RESULTS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tests.value
        for b in batches:
            n_words, hits, matches = [], b.column(place["hits"]).to_pylist(), b.column(place["matches"]).to_pylist()
            for first, shard in blocks(b.column(at), shard_bytes):
                counts, doc, start, test = search(shard, t, window)
                n_words += counts.tolist()
                o = np.argsort(doc, kind="stable")
                doc, start, test = doc[o], start[o], test[o]
                for d in np.unique(doc).tolist():
                    a, z = np.searchsorted(doc, [d, d + 1])
                    own, k = np.stack([start[a:z], start[a:z] + t.length[test[a:z]]], 1), first + d
                    if hits[k]:
                        own = np.concatenate([own, [(h["start"], h["end"]) for h in hits[k]]])
                    hits[k] = _union(own)
                    found = {m["item_id"]: m for m in matches[k] or []}
                    for m in _longest(start[a:z], test[a:z], t):
                        if m["item_id"] not in found or m["length"] > found[m["item_id"]]["length"]:
                            found[m["item_id"]] = m
                    matches[k] = sorted(found.values(), key=lambda m: m["item_id"])
            cols = list(b.columns)
            cols[place["n_words"]] = pa.array(n_words, pa.int64())
            cols[place["hits"]], cols[place["matches"]] = pa.array(hits, _HITS), pa.array(matches, _MATCHES)
            cols[place["items"]] = pa.array([[m["item_id"] for m in x] for x in matches], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, docs.schema)


def _blocks(benchmark: DataFrame, size: int) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """The items' ids and texts, about ``size`` bytes at a time; at least one block."""
    ids, texts, n, any_ = [], [], 0, False
    for row in benchmark.distinct().toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        n += len((row[1] or "").encode()) + 1
        if n >= size:
            yield ids, texts
            ids, texts, n, any_ = [], [], 0, True
    if ids or not any_:
        yield ids, texts


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row of ``docs`` with n_words; hits, the disjoint spans of words inside windows of items;
    items, the ids of items with such windows; matches, each such item's longest match and its places."""
    empty = "array<struct<start:bigint,end:bigint>>", "array<bigint>", "array<struct<item_id:bigint,doc_start:bigint,item_start:bigint,length:bigint>>"
    d = docs.drop(*[c for c in RESULTS if c != text])
    d = d.select("*", F.lit(0).cast("long").alias("n_words"), *(F.array().cast(t).alias(c) for c, t in zip(RESULTS[1:], empty)))
    spark = docs.sparkSession
    for k, (ids, texts) in enumerate(_blocks(benchmark.select(F.col(item_id).cast("long"), item_text), block_bytes)):
        if k:
            d = stored(d, "decontaminated")
        d = _pass(d, text, spark.sparkContext.broadcast(Tests.of(ids, texts, window)), window, shard_bytes)
    return d


def contaminated() -> Column:
    """Of a row of ``find``: whether it has hits."""
    return F.size("hits") > 0


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda s, h: s + h["end"] - h["start"])


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without a hit, with their own columns."""
    taken = {c: f"__dc_{c}" for c in docs.columns if c in RESULTS and c != text}
    found = find(docs.withColumnsRenamed(taken), benchmark, text, **options).where(~contaminated()).drop(*RESULTS)
    return found.withColumnsRenamed({v: k for k, v in taken.items()})
