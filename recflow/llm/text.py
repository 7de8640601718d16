"""Vectorised words and shingles over Arrow string columns.

A batch's texts lie in one byte buffer. Word borders are found on the whole
buffer, a word's hash is the difference of two prefix sums of a polynomial in
the bytes (shifted to the word's start), mixed with its length. Work goes
through the buffer in pieces of ``PIECE`` bytes cut at a border, so memory is
bounded whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
# odd multipliers with mixed bits; any would do
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes between words: white space, or everything in ASCII but letters and digits.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_cache: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _cache or len(_cache["up"]) < n:
        size = max(n, PIECE + 1)
        _cache["up"], _cache["down"] = _powers(_BASE, size), _powers(_INVERSE, size)
    return _cache["up"], _cache["down"]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def word_hashes(texts: pa.Array, separators: np.ndarray = SPACE,
                last: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z folded) and, per text, where its words begin
    (length: number of texts plus one). ``last`` gets the words' last bytes."""
    raw, off = buffer_of(texts)
    out, starts_at = [], []
    begins = np.unique(off[:-1])
    lo = 0
    while lo < len(raw):
        hi = min(lo + PIECE, len(raw))
        if hi < len(raw):  # cut at the last separator or text border; else let the word run on
            cut = np.flatnonzero(separators[raw[lo:hi]])
            border = begins[(begins > lo) & (begins <= hi)]
            best = max(lo + cut[-1] + 1 if len(cut) else lo, border[-1] if len(border) else lo)
            while best == lo:
                nxt = np.flatnonzero(separators[raw[hi:hi + PIECE]])
                border = begins[(begins > hi) & (begins <= hi + PIECE)]
                ends = [hi + nxt[0] + 1] if len(nxt) else []
                ends += [border[0]] if len(border) else []
                if ends or hi + PIECE >= len(raw):
                    best = min([*ends, len(raw)])
                hi = min(hi + PIECE, len(raw))
            hi = int(best)
        piece = _FOLD[raw[lo:hi]]
        solid = ~separators[piece]
        edge = np.zeros(hi - lo + 1, dtype=bool)
        edge[begins[(begins >= lo) & (begins < hi)] - lo] = True
        edge[0] = edge[-1] = True
        before = np.concatenate(([False], solid[:-1]))
        after = np.concatenate((solid[1:], [False]))
        s = np.flatnonzero(solid & (~before | edge[:-1]))
        e = np.flatnonzero(solid & (~after | edge[1:])) + 1
        up, down = _tables(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        out.append(mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _MIX2))
        starts_at.append(s + lo)
        if last is not None:
            last.append(piece[e - 1])
        lo = hi
    hashes = np.concatenate(out) if out else np.zeros(0, np.uint64)
    at = np.concatenate(starts_at) if starts_at else np.zeros(0, np.int64)
    return hashes, np.searchsorted(at, off)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``k``-word shingles; with
    fewer words the whole sequence is one shingle, without words none."""
    h, first = word_hashes(texts)
    joined = None
    if len(h) >= k:
        joined = h[: len(h) - k + 1].copy()
        for j in range(1, k):
            joined = mix64(joined) + h[j: len(h) - k + 1 + j]
        joined = mix64(joined)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            yield np.unique(joined[a: b - k + 1])
        elif b > a:
            short = h[a:a + 1].copy()
            for j in range(a + 1, b):
                short = mix64(short) + h[j:j + 1]
            yield mix64(short + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
