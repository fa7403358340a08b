"""Hashes of words and of word shingles for whole Arrow batches, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240229))
_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_FOLD = np.arange(256)
_FOLD[ord("A") : ord("Z") + 1] += 32
#: A random value for each byte, the same for A-Z as for a-z.
_VALUE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)[_FOLD]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _RNG.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK = 1 << 20  # bytes that are worked on at a time
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK + 1024)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def _hash_words(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word in ``data``; a text begins at each of ``firsts`` and ends words."""
    inside = _WORD[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[firsts] = True
    cut[-1] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    up, down = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=sums[1:])
    # A word's sum holds the powers from its start on; the inverse power makes it the same at every place.
    words = (sums[ends] - sums[starts]) * down[starts]
    return mix(words + (ends - starts).astype(np.uint64)), starts, ends


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a text column; nulls are empty."""
    plain = column.fill_null("").cast(pa.large_string()).cast(pa.large_binary())
    buffers = plain.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text of any length, piece by piece, cut at white space."""
    out, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data) and _WORD[data[end]]:
            space = np.flatnonzero(~_WORD[data[end : end + CHUNK]])
            end = end + int(space[0]) if len(space) else min(end + CHUNK, len(data))
        out.append(_hash_words(data[at:end], np.zeros(1, dtype=np.int64))[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most CHUNK bytes, or one longer text."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        yield at, end
        at = end


def word_hashes(data: np.ndarray, offsets: np.ndarray, at: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts ``at`` to ``end`` and, for each text, where its hashes begin (n + 1 offsets)."""
    lo, hi = int(offsets[at]), int(offsets[end])
    if end - at == 1 and hi - lo > CHUNK:
        words = _long_text(data[lo:hi])
        return words, np.array([0, len(words)])
    if hi == lo:
        return np.zeros(0, dtype=np.uint64), np.zeros(end - at + 1, dtype=np.int64)
    bounds = offsets[at : end + 1] - lo
    words, starts, _ = _hash_words(data[lo:hi], bounds[:-1][np.diff(bounds) > 0])
    return words, np.searchsorted(starts, bounds)


def shingle_sets(words: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; of fewer than ``size`` words, all words are one shingle."""
    n = len(words)
    if n >= size:
        total = words[: n - size + 1] * _PLACE[0]
        for k in range(1, size):
            total = total + words[k : n - size + 1 + k] * _PLACE[k]
        all_shingles = mix(total)
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        count = hi - lo
        if count >= size:
            yield np.unique(all_shingles[lo : hi - size + 1])
        elif count:
            short = np.sum(words[lo:hi] * _PLACE[:count], dtype=np.uint64, keepdims=True)
            yield mix(short + count * _PLACE[63:])
        else:
            yield np.zeros(0, dtype=np.uint64)
