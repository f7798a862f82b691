"""Byte-level BPE encoding and decoding with a segment tree per piece.

The pattern's matches ("pieces") are merged separately.  No piece reaches over a change from other
characters to white space, so texts are first cut into chunks there (one space stays in front of a
chunk); each worker remembers the ids of the chunks that it has met.  A segment tree over a piece's byte positions
holds, for each live pair of neighbours, its rank and position; the root is the leftmost pair of
lowest rank.  A merge removes the right neighbour and makes a point update for it, for the merged token
and for the token before it.

Defined results: a null text is encoded as an empty one (no ids); repeated rows give repeated results;
an empty table gives no rows; a column that carries the result's name is replaced by the result.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Chunks, and merged pieces, of a generation: a worker remembers two generations of each. No result depends on it.
REMEMBERED = 100_000
_NONE = 1 << 62


@functools.lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a vocabulary file: an absolute path, or the name of an installed one."""
    with open(path if "/" in path else public_tokenizers.path(path), "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


@functools.lru_cache(maxsize=4)
def tokens(path: str) -> dict[int, bytes]:
    return {r: t for t, r in ranks(path).items()}


# The code points of Unicode's property White_Space.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
chunks = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+").findall


@functools.lru_cache(maxsize=4)
def splitter(pattern: str = public_tokenizers.PATTERN):
    import regex

    # \s is Unicode's White_Space in the reference library; this module's own \s has more characters
    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                         .replace(r"\S", r"\P{White_Space}"))


def merge(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    if piece in rank:
        return [rank[piece]]
    n = len(piece)
    part = [piece[i:i + 1] for i in range(n)]  # the token that begins at a position, while it is live
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    width = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [_NONE] * (2 * width)  # leaf i: rank of the pair beginning at i, then i

    def leaf(i: int) -> int:
        j = after[i]
        r = rank.get(part[i] + part[j]) if j < n else None
        return _NONE if r is None else r << 40 | i

    def put(i: int, value: int) -> None:
        k = width + i
        tree[k] = value
        while k > 1:
            k >>= 1
            a, b = tree[2 * k], tree[2 * k + 1]
            m = a if a < b else b
            if tree[k] == m:
                return
            tree[k] = m

    for i in range(n - 1):
        tree[width + i] = leaf(i)
    for k in range(width - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    while tree[1] != _NONE:
        i = tree[1] & ((1 << 40) - 1)
        j = after[i]
        part[i] += part[j]
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        if j < n - 1:
            put(j, _NONE)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    out, i = [], 0
    while i < n:
        out.append(rank[part[i]])
        i = after[i]
    return out


class _Pairs:
    """(id, id) -> id of the token that both make together, or -1, for whole arrays."""

    def __init__(self, path: str):
        rank = ranks(path)
        found = {(rank[t[:i]] << 32 | rank[t[i:]]): r for t, r in rank.items() for i in range(1, len(t))
                 if t[:i] in rank and t[i:] in rank}
        keys = np.fromiter(found.keys(), np.int64, len(found))
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.fromiter(found.values(), np.int64, len(found))[order]
        self.byte = np.array([rank[bytes([i])] for i in range(256)], np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ids[at], -1)


@functools.lru_cache(maxsize=4)
def _pairs(path: str) -> _Pairs:
    return _Pairs(path)


def merge_many(pieces: list[bytes], width: int, path: str) -> list[bytes]:
    """Ids (little-endian unsigned 32-bit) of pieces of 2 to ``width`` bytes, a power of two.

    The trees of all pieces lie in one array and are worked on together, one merge in each at a time.
    Position 0 and the last are sentinels; leaf i of a tree has the pair that begins at position i.
    """
    pairs, n, w = _pairs(path), len(pieces), width + 2
    size = 1 << (w - 1).bit_length()
    lengths = np.fromiter(map(len, pieces), np.int64, n)
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
    here = np.arange(width)[None, :] < lengths[:, None]
    tok = np.full((n, w), -1, np.int64)
    tok[:, 1:-1] = np.where(here, pairs.byte[raw], -1)
    tree = np.full((n, 2 * size), _NONE, np.int64)
    first = pairs(tok[:, :-1].ravel(), tok[:, 1:].ravel()).reshape(n, w - 1)
    at = np.arange(w - 1)
    tree[:, size:size + w - 1] = np.where(first >= 0, first << 16 | at, _NONE)
    level = size
    while level > 1:
        level >>= 1
        np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2], out=tree[:, level:2 * level])
    after = np.broadcast_to(np.minimum(np.arange(1, w + 1), w - 1), (n, w)).copy()
    before = np.broadcast_to(np.maximum(np.arange(-1, w - 1), 0), (n, w)).copy()
    tok, tree, after, before = tok.ravel(), tree.ravel(), after.ravel(), before.ravel()

    def put(base: np.ndarray, pos: np.ndarray, value: np.ndarray | int) -> None:
        node = size + pos
        tree[base + node] = value
        while node.size and node[0] > 1:  # all nodes are of one level
            node = node >> 1
            left = base + 2 * node
            tree[base + node] = np.minimum(tree[left], tree[left + 1])

    def key(merged: np.ndarray, pos: np.ndarray) -> np.ndarray:
        return np.where(merged >= 0, merged << 16 | pos, _NONE)

    live = np.flatnonzero(tree[1::2 * size] != _NONE)
    while live.size:
        base, row = live * (2 * size), live * w
        root = tree[base + 1]
        i = root & 0xFFFF
        merged = root >> 16
        j = after[row + i]
        k, h = after[row + j], before[row + i]
        tok[row + i] = merged
        tok[row + j] = -1
        after[row + i] = k
        before[row + k] = i
        put(base, j, _NONE)
        put(base, i, key(pairs(merged, tok[row + k]), i))
        put(base, h, key(pairs(tok[row + h], merged), h))
        live = live[tree[base + 1] != _NONE]
    tok = tok.reshape(n, w)
    kept = tok >= 0
    ends = np.cumsum(kept.sum(1))[:-1] * 4
    flat = tok[kept].astype("<u4").tobytes()
    return [flat[a:b] for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(flat)])]


class Recent:
    """What a worker has met lately, in two generations: when the younger is full it becomes the older one, and the older
    one is forgotten; what is met again moves to the younger.  So common entries stay, and memory is bounded."""

    def __init__(self, size: int = REMEMBERED):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys: set) -> list:
        """Makes room, moves known keys to the younger generation and returns the unknown ones."""
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        new = []
        for k in keys:
            if k not in young:
                if (known := old.get(k)) is None:
                    new.append(k)
                else:
                    young[k] = known
        return new


class Chunks(Recent):
    """Chunk of a text -> its ids as little-endian unsigned 32-bit integers, as ``encode`` gives them
    for a list of chunks."""

    def __init__(self, encode, size: int = REMEMBERED):
        super().__init__(size)
        self.encode = encode

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids.  A block of texts at a time is cut, so that few chunks are held at once."""
        out, block, chars = [], [], 0
        for k, t in enumerate(texts):
            block.append(chunks(t) if t else [])
            chars += len(t or "")
            if chars > 500_000 or k + 1 == len(texts):
                new = self.missing(set().union(*block))
                self.young.update(zip(new, self.encode(new)))
                out += [b"".join(map(self.young.__getitem__, x)) for x in block]
                block, chars = [], 0
        return out


@functools.lru_cache(maxsize=4)
def _merged(path: str) -> Recent:
    return Recent()


def encode_chunks(texts: list[str], path: str) -> list[bytes]:
    """Each text's ids; equal pieces are merged once."""
    rank, split, known = ranks(path), splitter().findall, _merged(path)
    cut = [split(t) for t in texts]
    ids: dict[str, bytes] = {}
    rest = set()
    for p in set().union(*cut):
        if (r := rank.get(p.encode())) is not None:
            ids[p] = r.to_bytes(4, "little")
        else:
            rest.add(p)
    by_width: dict[int, list[tuple[str, bytes]]] = {}
    for p in known.missing(rest):
        b = p.encode()
        by_width.setdefault(max(8, 1 << (len(b) - 1).bit_length()), []).append((p, b))
    for width, group in by_width.items():
        if width > 64:
            known.young.update((p, np.array(merge(b, rank), "<u4").tobytes()) for p, b in group)
            continue
        step = 131072 // width
        for x in range(0, len(group), step):
            part = group[x:x + step]
            known.young.update(zip([p for p, _ in part], merge_many([b for _, b in part], width, path)))
    ids.update((p, known.young[p]) for p in rest)
    return [b"".join(map(ids.__getitem__, x)) for x in cut]


@functools.lru_cache(maxsize=4)
def _known(path: str) -> Chunks:
    return Chunks(functools.partial(encode_chunks, path=path))


def encode_texts(texts: list[str | None], path: str = VOCABULARY) -> list[bytes]:
    """Each text's ids, little-endian unsigned 32-bit."""
    return _known(path).texts(texts)


def decode_ids(ids: bytes | None, path: str = VOCABULARY) -> bytes:
    return b"".join(map(tokens(path).__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def _replaced(df: DataFrame, source: str, target: str, work, kind: pa.DataType) -> DataFrame:
    """``df`` with the column ``source`` replaced by ``target`` = work(its values), in batches."""
    df = df.drop(*[c for c in df.columns if c.lower() == target.lower() and c != source])
    at, names = df.columns.index(source), [target if c == source else c for c in df.columns]
    fields = ", ".join(f"`{n}` {'binary' if n == target else t}" for n, (_, t) in zip(names, df.dtypes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for x in range(0, whole.num_rows, 256):  # few texts are Python objects at once
                cols = list(whole.slice(x, 256).columns)
                cols[at] = pa.array(work(cols[at].to_pylist()), kind)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.mapInArrow(run, fields)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``text`` replaced by ``ids``: binary, little-endian unsigned 32-bit integers."""
    return _replaced(docs, text, ids, lambda texts: encode_texts(texts, vocabulary), pa.binary())


def decode(encoded: DataFrame, ids: str = "ids", out: str = "decoded", vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` with ``ids`` replaced by the bytes that they stand for."""
    return _replaced(encoded, ids, out, lambda ids: [decode_ids(x, vocabulary) for x in ids], pa.binary())
