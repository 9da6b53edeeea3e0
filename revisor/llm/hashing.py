"""Word, shingle and window hashes of UTF-8 texts, in numpy inside tasks.

A word's hash is a polynomial over its bytes modulo 2**64 with random byte
values, finished by a bit mixer, computed for all words of a text at once
from prefix sums.  Separators are ASCII, so working on bytes is exact for
UTF-8.  Words of ``LONG_WORD`` bytes or more are hashed by BLAKE2 instead: modulo a
power of two, texts built by doubling (a Thue-Morse pattern and its complement)
agree from 1,024 bytes on whatever the base.  Texts are hashed in segments of
``SEGMENT`` bytes, so that none needs more than a few times that beyond one hash
per word.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np

SEGMENT = 1 << 20
LONG_WORD = 256
M64 = (1 << 64) - 1

#: White space that parts words, and the A-Z folding.
WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

_rng = np.random.default_rng(20240101)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(WHITE_SPACE)] = True


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base & M64), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _tables.get("up")
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        _tables["up"], _tables["down"] = powers(_BASE, size), powers(_BASE_INVERSE, size)
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (xor-shift, multiply, twice)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, is_separator: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the maximal runs of non-separator bytes."""
    parted = np.ones(len(data) + 2, dtype=bool)
    parted[1:-1] = is_separator[data]
    edges = np.flatnonzero(parted[1:] != parted[:-1])
    return edges[0::2], edges[1::2]


def _segment_hashes(data: np.ndarray, fold: np.ndarray, is_separator: np.ndarray) -> np.ndarray:
    data = fold[data]
    starts, ends = word_bounds(data, is_separator)
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    for k in np.flatnonzero(ends - starts >= LONG_WORD).tolist():
        hashes[k] = int.from_bytes(hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest(), "little")
    return hashes


def word_hashes(data: np.ndarray, fold: np.ndarray = FOLD, is_separator: np.ndarray = IS_SPACE) -> np.ndarray:
    """One 64-bit hash for each word of the text, in order."""
    if len(data) <= SEGMENT:
        return _segment_hashes(data, fold, is_separator)
    parts, at = [], 0
    while at < len(data):
        block = data[at:at + SEGMENT]
        if at + len(block) < len(data):
            breaks = np.flatnonzero(is_separator[block])
            if not len(breaks):  # a word as long as a segment: find its end block by block
                end = at + len(block)
                digest = hashlib.blake2b(fold[block].tobytes(), digest_size=8)
                while end < len(data):
                    block = data[end:end + SEGMENT]
                    breaks = np.flatnonzero(is_separator[block])
                    cut = int(breaks[0]) if len(breaks) else len(block)
                    digest.update(fold[block[:cut]].tobytes())
                    end += cut
                    if len(breaks):
                        break
                parts.append(np.frombuffer(digest.digest(), dtype=np.uint64))
                at = end
                continue
            block = block[:int(breaks[-1]) + 1]
        parts.append(_segment_hashes(block, fold, is_separator))
        at += len(block)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


KEPT_POWERS = 1 << 16  # words of a text up to which a seed's powers are kept


@functools.cache
def _window_base(seed: int) -> int:
    return (2 * int(mix(np.array([seed], dtype=np.uint64))[0]) + 1) & M64


@functools.lru_cache(maxsize=64)
def _kept_powers(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = _window_base(seed)
    return powers(base, size), powers(pow(base, -1, 1 << 64), size)


def _window_powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers, or more, of a seed's base and of its inverse; those of a long text are not kept."""
    if n > KEPT_POWERS:
        return _kept_powers.__wrapped__(seed, n)
    return _kept_powers(seed, 1 << max(10, (n - 1).bit_length()))


def windows(words: np.ndarray, size: int, seed: int = 1, at: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` consecutive words, or of those that start ``at`` some places (``size`` above 8)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = _window_base(seed)
    if size <= 8:
        total = np.zeros(n, dtype=np.uint64)
        weight = 1
        for k in range(size):
            total += words[k:k + n] * np.uint64(weight)
            weight = weight * base & M64
        return mix(total)
    up, down = _window_powers(seed, len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[:len(words)], out=sums[1:])
    if at is not None:
        return mix((sums[at + size] - sums[at]) * down[at])
    return mix((sums[size:] - sums[:-size]) * down[:n])


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return words
    if len(words) < size:
        return windows(words, len(words), seed=len(words) + 100)
    return np.unique(windows(words, size))
