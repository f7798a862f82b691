"""Sets of word shingles of whole texts (numpy, many texts at once)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tessera.llm.words import SPACED, grams, mix, words


@dataclass
class Shingles:
    """``hash``: the distinct shingles of all texts; ``text``: whose each is, ascending; ``n``: how many each text has."""

    hash: np.ndarray
    text: np.ndarray
    n: np.ndarray

    def signatures(self) -> np.ndarray:
        """A number for each text's set; equal sets have equal ones."""
        total = np.zeros(len(self.n) + 1, np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(self.hash ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
        ends = np.concatenate([[0], np.cumsum(self.n)])
        total = sums[ends[1:]] - sums[ends[:-1]]
        return mix(total + self.n.astype(np.uint64))


def by_text(key: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The order by text, then key."""
    o = np.argsort(key)
    t = text[o]
    return o[np.argsort(t.astype(np.uint16) if len(t) and t.max() < 1 << 16 else t, kind="stable")]


def shingles(texts: list[bytes | str | None], size: int) -> Shingles:
    """Distinct runs of ``size`` words between white space (A-Z lower-cased); a text of fewer words has
    one, the whole of it; a text without words has none."""
    w = words(texts, SPACED)
    n, of = w.counts(), w.text_of()
    whole = np.flatnonzero(np.arange(len(w.hash)) + size <= w.first[1:][of]) if len(of) else np.zeros(0, np.int64)
    hashes, owners = [grams(w.hash, size)[whole]], [of[whole]]
    for k in range(1, size):
        short = np.flatnonzero(n == k)
        if short.size:
            hashes.append(grams(w.hash, k)[w.first[short]])
            owners.append(short)
    h, t = np.concatenate(hashes), np.concatenate(owners)
    o = by_text(h, t)
    h, t = h[o], t[o]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])]) if len(h) else np.zeros(0, bool)
    h, t = h[new], t[new]
    return Shingles(h, t, np.bincount(t, minlength=len(texts)))


def common(a: Shingles, b: Shingles) -> np.ndarray:
    """Sizes of the intersections of the texts of the same place in two lists."""
    h, t = np.concatenate([a.hash, b.hash]), np.concatenate([a.text, b.text])
    o = by_text(h, t)
    h, t = h[o], t[o]
    same = np.flatnonzero((h[1:] == h[:-1]) & (t[1:] == t[:-1]))
    return np.bincount(t[same], minlength=len(a.n))
