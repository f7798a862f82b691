"""Token ids in wavelet matrices: one compressed binary file per shard.

Documents are sorted by id over range partitions and encoded there; about ``BLOCK_TOKENS`` ids at a time
make a shard, which always ends with a document.  A shard's bytes are its whole file::

    magic "WVM1" | header length (u32) | header (JSON: n, depth, docs) | zstd of the body
    body = document starts (u64, docs + 1) | zeros per plane (u64) | per plane its bits (packed, most
           significant plane first, least significant bit first) | per plane the ones before every 512 bits (u32)

Each plane has rank directories, so that access, counting and occurrence lookup work on the planes; ids
are not stored in any other form.  Files are written by Spark (one binary column), so they can lie in any
store that Spark can write.

Defined results: a null or empty text has the end id alone; rows with equal ids are ordered by text; null
ids come first; an empty table gives no shards; columns besides the id and the text aren't stored.
"""

from __future__ import annotations

import functools
import json
import os
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import Chunks, splitter
from tessera.llm.shared import stored

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: A shard is closed at the end of the document with which it has this many ids.
BLOCK_TOKENS = 1 << 20
#: Chunks of a generation; a worker remembers two.
REMEMBERED = 150_000
_STEP = 512


class WaveletMatrix:
    """Bit planes with rank and select over a sequence of unsigned integers."""

    def __init__(self, planes: list[np.ndarray], ones: list[np.ndarray], zeros: np.ndarray, n: int):
        self.planes, self.ones, self.zeros, self.n, self.depth = planes, ones, zeros, n, len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, depth: int) -> WaveletMatrix:
        cur, planes, ones, zeros = ids.astype(np.uint16 if depth <= 16 else np.uint32), [], [], []
        for level in range(depth - 1, -1, -1):
            bit = (cur & cur.dtype.type(1 << level)) != 0
            bits = np.packbits(bit, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % (_STEP // 8), np.uint8)])
            each = np.bitwise_count(bits.view("<u8")).reshape(-1, _STEP // 64).sum(1)
            planes.append(bits)
            ones.append(np.concatenate([[0], np.cumsum(each)]).astype("<u4"))
            zeros.append(len(cur) - int(ones[-1][-1]))
            cur = np.concatenate([cur[~bit], cur[bit]])
        return cls(planes, ones, np.array(zeros, np.int64), len(ids))

    def _rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a plane before each position."""
        block, rest = at // _STEP, at % _STEP
        words = np.concatenate([self.planes[level], np.zeros(_STEP // 8, np.uint8)]).view("<u8") if np.any(at >= self.n) else self.planes[level].view("<u8")
        out = self.ones[level][block].astype(np.int64)
        for k in range(_STEP // 64):
            left = np.clip(rest - 64 * k, 0, 64)
            mask = np.where(left == 64, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(left, 63).astype(np.uint64)) - np.uint64(1))
            out += np.bitwise_count(words[np.minimum(block * (_STEP // 64) + k, len(words) - 1)] & mask)
        return out

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at the positions."""
        at, out = np.asarray(at, np.int64).copy(), np.zeros(len(at), np.uint32)
        for level in range(self.depth):
            bit = self.planes[level][at >> 3] >> (at & 7).astype(np.uint8) & 1
            r = self._rank1(level, at)
            at = np.where(bit == 1, self.zeros[level] + r, at - r)
            out = out << np.uint32(1) | bit
        return out

    def rank(self, value: int, at: int) -> int:
        """How often ``value`` occurs before position ``at``."""
        a, b = self._range(value, at)
        return b - a

    def _range(self, value: int, at: int) -> tuple[int, int]:
        if value >> self.depth:
            return 0, 0
        ends = np.array([0, at], np.int64)
        for level in range(self.depth):
            r = self._rank1(level, ends)
            ends = self.zeros[level] + r if value >> (self.depth - 1 - level) & 1 else ends - r
        return int(ends[0]), int(ends[1])

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int) -> np.ndarray:
        """All positions of ``value``, ascending."""
        a, b = self._range(value, self.n)
        at = np.arange(a, b, dtype=np.int64)
        for level in range(self.depth - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], bitorder="little")[:self.n]
            if value >> (self.depth - 1 - level) & 1:
                at = np.flatnonzero(bits)[at - self.zeros[level]]
            else:
                at = np.flatnonzero(bits == 0)[at]
        return at

    def values(self) -> np.ndarray:
        """All ids in order: undoes the planes' stable partitions, from the last to the first."""
        out = np.zeros(self.n, np.uint32)
        for level in range(self.depth - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], bitorder="little")[:self.n].view(bool)
            below, zeros = out, self.zeros[level]
            out = np.empty(self.n, np.uint32)
            out[~bit] = below[:zeros]
            out[bit] = below[zeros:] | np.uint32(1 << (self.depth - 1 - level))
        return out


def pack(ids: np.ndarray, starts: np.ndarray, depth: int) -> bytes:
    """The file of a shard."""
    w = WaveletMatrix.build(ids.astype(np.uint32), depth)
    head = json.dumps({"n": w.n, "depth": depth, "docs": len(starts) - 1}).encode()
    body = b"".join([starts.astype("<u8").tobytes(), w.zeros.astype("<u8").tobytes(),
                     *(p.tobytes() for p in w.planes), *(o.tobytes() for o in w.ones)])
    return b"WVM1" + struct.pack("<I", len(head)) + head + zstandard.compress(body, 1)


def unpack(file: bytes) -> tuple[WaveletMatrix, np.ndarray]:
    """The matrix of a shard and the starts of its documents (one more than documents)."""
    if file[:4] != b"WVM1":
        raise ValueError("not a wavelet matrix shard")
    size = struct.unpack("<I", file[4:8])[0]
    head = json.loads(file[8:8 + size])
    body, at, n, depth = zstandard.decompress(file[8 + size:]), 0, head["n"], head["depth"]

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    starts, zeros = take("<u8", head["docs"] + 1).astype(np.int64), take("<u8", depth).astype(np.int64)
    blocks = -(-n // _STEP)
    planes = [take("u1", blocks * (_STEP // 8)) for _ in range(depth)]
    return WaveletMatrix(planes, [take("<u4", blocks + 1) for _ in range(depth)], zeros, n), starts


class Encoder:
    """Whole texts to ids with the tokenizers library.

    Where the file's pre-tokenizer is the byte-level one, equal chunks are split once and the library's model
    is asked for each distinct piece; otherwise, and where a special token's string could stand in a text,
    the text is encoded in one call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path if "/" in path else public_tokenizers.path(path))
        self.size, self.model = self.own.get_vocab_size(), self.own.model
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]
        kind = json.loads(self.own.to_str())
        pre = kind["pre_tokenizer"] or {}
        self.plain = kind["normalizer"] is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        # the byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for those from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(own))}
        self.known = Chunks(self._chunks, REMEMBERED)

    def _chunks(self, new: list[str]) -> list[bytes]:
        split, ask, letters = splitter().findall, self.model.tokenize, self.alphabet
        cut = [split(c) for c in new]
        ids = {p: array("I", [t.id for t in ask(p.encode().decode("latin-1").translate(letters))]).tobytes() for p in set().union(*cut)}
        return [ids[c[0]] if len(c) == 1 else b"".join(map(ids.__getitem__, c)) for c in cut]

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids, little-endian unsigned 32-bit."""
        odd = {k for k, t in enumerate(texts) if t and (not self.plain or any(s in t for s in self.special))}
        out = self.known.texts([None if k in odd else t for k, t in enumerate(texts)] if odd else texts)
        for k in odd:
            out[k] = array("I", self.own.encode(texts[k], add_special_tokens=False).ids).tobytes()
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
          end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Writes the shards of ``docs``: rows (part, shard, n, doc_ids, file), ordered by part and shard."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, names, ids, n = TaskContext.get().partitionId(), 0, [], [], 0
        depth = max(1, max(end_id, encoder(vocabulary).size - 1).bit_length())
        end = np.array([end_id], "<u4").tobytes()

        def close() -> pa.RecordBatch:
            starts = np.cumsum([0, *map(len, ids)]) // 4
            file = pack(np.frombuffer(b"".join(ids), "<u4"), starts, depth)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()),
                                               pa.array([starts[-1]], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([file], pa.binary())],
                                              names=["part", "shard", "n", "doc_ids", "file"])

        for b in batches:
            for x in range(0, b.num_rows, 512):
                rows = b.slice(x, 512)
                for name, own in zip(rows.column(0).to_pylist(), encoder(vocabulary).texts(rows.column(1).to_pylist())):
                    names.append(name)
                    ids.append(own + end)
                    n += len(own) // 4 + 1
                    if n >= block_tokens:
                        yield close()
                        shard, names, ids, n = shard + 1, [], [], 0
        if names:
            yield close()

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ["doc_id", "digest", "place"]  # rows of one id, or without one, spread too
    d = d.withColumns({"digest": F.xxhash64("text"), "place": F.monotonically_increasing_id()}).repartitionByRange(*order).sortWithinPartitions(*order)
    d.select("doc_id", "text").mapInArrow(shards, "part int, shard int, n long, doc_ids array<long>, file binary").write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all shards with ``start``, the ids in all shards before: (part, shard, n, doc_ids, file, start).

    Offsets are summed over the shards of a part, and over the parts, of which there is one row each.
    The small table of offsets is written, so that its size is known before the join.
    """
    sizes = spark.read.parquet(path).select("part", "shard", "n")
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("part").orderBy("shard")) - F.col("n")
    starts = sizes.withColumn("inside", inside).join(parts, "part").select("part", "shard", (F.col("inside") + F.col("before")).alias("start"))
    return spark.read.parquet(path).join(stored(starts, "shard-starts"), ["part", "shard"])


def documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of each document, from the shards' planes; ids is binary, little-endian u32."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for names, file, start in zip(*(b.column(c) for c in ("doc_ids", "file", "start"))):
                w, at = unpack(file.as_py())
                data = w.values().astype("<u4").tobytes()
                ids = [data[4 * x:4 * y] for x, y in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(names.as_py(), pa.int64()), pa.array(at[:-1] + start.as_py(), pa.int64()),
                                                  pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"])

    return shards.select("doc_ids", "file", "start").mapInArrow(rows, "doc_id long, start long, ids binary")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """(part, shard, n, positions) of one id in each shard that has it; positions count from the corpus' start."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, shard, file, start in zip(*(b.column(c).to_pylist() for c in ("part", "shard", "file", "start"))):
                w, _ = unpack(file)
                if n := w.count(token):
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([n], pa.int64()),
                                                      pa.array([w.select(token) + start], pa.list_(pa.int64()))], names=["part", "shard", "n", "positions"])

    return shards.select("part", "shard", "file", "start").mapInArrow(rows, "part int, shard int, n long, positions array<long>")
