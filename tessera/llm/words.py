"""Words of whole texts as 64-bit hashes, for many texts at once (numpy over their UTF-8 bytes)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15 & ~7 | 3)  # odd, and 1 - _STEP has one factor of 2
_BACK = _U(pow(int(_STEP), -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_AT_ONCE = 250_000
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]

#: Words between ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[32, *range(9, 14)]] = False
#: Words of digits, letters and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_STEP, _BACK)):
            full = np.full(max(n, _AT_ONCE + (1 << 16)), base, _U)
            full[0] = 1
            _powers[k] = np.multiply.accumulate(full)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them evenly."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Words:
    """``hash``: each word's hash, text after text; ``first``: where each text begins (one more than texts)."""

    hash: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def words(texts: list[bytes | str | None], kind: np.ndarray) -> Words:
    """Hashes of the words (A-Z lower-cased) of each text; a null text has none."""
    data = [t.encode() if isinstance(t, str) else t or b"" for t in texts]
    done, run, size, n = [], [], 0, len(data)
    for k, d in enumerate(data):  # about a quarter of a megabyte at a time: the arrays over bytes are eight times as large
        run.append(d)
        size += len(d) + 1
        if size >= _AT_ONCE or k + 1 == n:
            done.append(_words(run, kind))
            run, size = [], 0
    if not done:
        return Words(np.zeros(0, _U), np.zeros(1, np.int64))
    each = np.concatenate([w.counts() for w in done])
    return Words(np.concatenate([w.hash for w in done]), np.concatenate([[0], np.cumsum(each)]))


def _words(data: list[bytes], kind: np.ndarray) -> Words:
    ends = np.cumsum([0, *(len(d) + 1 for d in data)])
    b = np.frombuffer(b" ".join([*data, b""]), np.uint8)  # a byte that no word has ends each text
    inside = kind[b]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    table = _BYTE.copy()
    table[65:91] = table[97:123]
    up, down = _power(len(b))
    total = np.zeros(len(b) + 1, _U)
    np.cumsum(table[b] * up, out=total[1:])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))
    h[h == 0] = 1  # 0 stands for no word
    return Words(h, np.searchsorted(start, ends))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n hashes, order and all."""
    if len(hashes) < n:
        return np.zeros(0, _U)
    out = np.zeros(len(hashes) - n + 1, _U)
    for k in range(n):
        out = mix(out + hashes[k:len(hashes) - n + 1 + k]) + _U(k + 1) if n <= 4 else out * _STEP + hashes[k:len(hashes) - n + 1 + k]
    return mix(out + _U(n))


def blocks(texts: pa.Array | list[str | None], size: int = 2_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, encoded texts) of runs of texts with about ``size`` bytes; no text is cut."""
    column = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
    column = column.cast(pa.binary())
    first, run, n = 0, [], 0
    for x in range(0, len(column), 128):  # few texts are Python objects at once
        for t in column.slice(x, 128).to_pylist():
            run.append(t or b"")
            n += len(run[-1]) + 1
            if n >= size:
                yield first, run
                first, run, n = first + len(run), [], 0
    if run:
        yield first, run
