"""Vectorised word scanning over UTF-8 buffers: spans, 64-bit span hashes, shingles."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240607))
_MIX = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * U(2) + U(1)
_HEAD = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of the first k bytes of a word of eight
LONG = 64  # longer spans are hashed one by one by xxh3


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h = h * U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def word_spans(b: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per row) of the words ``[^\\x20\\x09-\\x0D]+``; rows end words."""
    n = len(b)
    word = np.empty(n + 2, bool)
    word[0] = word[-1] = False
    np.logical_not(SPACES[b], out=word[1:-1])
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(word[1:-1] & (edge[:-1] | ~word[:-2]))
    ends = np.flatnonzero(word[1:-1] & (edge[1:] | ~word[2:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offs))


def lowered(b: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return _LOWER[b]


def span_keys(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True, lanes: int = 2) -> list[np.ndarray]:
    """``lanes`` independent 64-bit hashes of byte spans; equal bytes (A-Z as a-z with ``lower``) give equal hashes.

    Each lane chains the span's words of eight bytes through the finaliser, so it has no families of colliding spans; spans
    of up to eight bytes and one length never collide. Spans over ``LONG`` bytes are digested by xxh3 with the lane's seed.
    """
    if not len(starts):
        return [np.zeros(0, U) for _ in range(lanes)]
    wide = np.zeros(len(b) + 16, np.uint8)
    wide[: len(b)] = lowered(b) if lower else b
    words = np.ndarray((len(b) + 8,), "<u8", buffer=wide, strides=(1,))
    size = ends - starts
    first = words[starts] & _HEAD[np.minimum(size, 8)]
    seeds = size.astype(U) * _MIX[15]
    out = [mix(first ^ (seeds + _MIX[14 - k])) for k in range(lanes)]
    at, place = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(at):
        block = words[starts[at] + place] & _HEAD[np.minimum(size[at] - place, 8)]
        for k, h in enumerate(out):
            h[at] = mix((h[at] ^ block) * _MIX[12 - k])
        place += 8
        at = at[size[at] > place]
    for i in np.flatnonzero(size > LONG).tolist():
        raw = wide[starts[i] : ends[i]].data
        for k, h in enumerate(out):
            h[i] = xxhash.xxh3_64_intdigest(raw, seed=k + 1)
    return out


def span_hash(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """The first lane of ``span_keys``."""
    return span_keys(b, starts, ends, lower, 1)[0]


def shingles(words: np.ndarray, counts: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row of each) of the k-word shingles; a row of 1 to k-1 words gives its whole sequence as one."""
    n, row = len(words), np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    left = np.repeat(ends, counts) - np.arange(n)  # words from here to the row's end
    h = np.zeros(n, U)
    for j in range(min(k, n)):
        h[: n - j] += np.where(left[: n - j] > j, words[j:] * _MIX[j], U(0))
    first = np.repeat(ends - counts, counts) == np.arange(n)
    use = (left >= k) | (first & (left < k))
    h += np.where(left < k, left.astype(U) * _MIX[14], U(0))
    return mix(h[use]), row[use]
