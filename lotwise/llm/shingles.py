"""Word shingles of Arrow text batches as 64-bit hashes, computed on whole buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
CHUNK_BYTES = 2 << 20
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_PLACES = mixed((np.arange(1, WORDS + 1, dtype=_U)) * _ODD) | _U(1)
_BYTE = mixed((np.arange(256, dtype=_U) + _U(77)) * _ODD)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE_OF = _BYTE[_LOWER]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        made = []
        for base in (_BASE, inverse):
            p = np.full(size, _U(base))
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of texts that lie one after another, and each text's first word.

    ``bounds`` are the texts' byte offsets, the end included. The hash of a word is a difference of prefix sums.
    """
    n = len(data)
    if not n:
        return np.empty(0, _U), np.zeros(len(bounds), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:n]
    end = word
    end[:-1] &= start[1:] | ~word[1:]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_BYTE_OF[data] * up[:n], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mixed(hashes + (ends - starts).astype(_U) * _ODD), np.searchsorted(starts, bounds)


def _long_text(data: np.ndarray) -> np.ndarray:
    """Word hashes of one text, piece by piece; pieces end at white space."""
    out, at = [], 0
    while at < len(data):
        to = min(at + CHUNK_BYTES, len(data))
        while to < len(data) and not _SPACE[data[to]]:
            gap = np.flatnonzero(_SPACE[data[to:to + CHUNK_BYTES]])
            to = to + int(gap[0]) if len(gap) else min(to + CHUNK_BYTES, len(data))
        out.append(word_hashes(data[at:to], np.array([0, to - at]))[0])
        at = to
    return np.concatenate(out) if out else np.empty(0, _U)


def _of_words(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's words; fewer words than a shingle are one."""
    n = len(words)
    if n == 0:
        return words
    if n < WORDS:
        return mixed(np.array([n], dtype=_U) * _ODD + (words * _PLACES[:n]).sum())
    out = words[:n - WORDS + 1] * _PLACES[0]
    for k in range(1, WORDS):
        out = out + words[k:n - WORDS + 1 + k] * _PLACES[k]
    return np.unique(mixed(out))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text of an Arrow column its distinct shingles as sorted hashes; null and empty ones have none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1)
        to = min(to, len(texts))
        piece = data[offsets[at]:offsets[to]]
        if len(piece) > CHUNK_BYTES:
            yield _of_words(_long_text(piece))
        else:
            words, firsts = word_hashes(piece, offsets[at:to + 1] - offsets[at])
            for k in range(to - at):
                yield _of_words(words[firsts[k]:firsts[k + 1]])
        at = to
