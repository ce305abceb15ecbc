"""Hashed words of a text, by array operations inside tasks.

A word is a maximal run of letters and digits of ASCII, underscores and characters beyond ASCII, in lower case.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes of a word beyond which it is hashed by itself.
LONG_WORD = 256
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Ends of sentences and lines, and capitals of ASCII.
END = np.zeros(256, np.int32)
END[[10, 33, 46, 63]] = 1
UPPER_A = np.zeros(256, bool)
UPPER_A[65:91] = True
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_powers: list = [None, None]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no pattern of the input."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of a base, and of its inverse, modulo 2**64."""
    if _powers[which] is None or len(_powers[which][0]) < n:
        pair = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            with np.errstate(over="ignore"):
                steps = np.full(max(1 << 14, 1 << (n - 1).bit_length()), base, np.uint64)
                steps[0] = 1
                pair.append(np.multiply.accumulate(steps))
        _powers[which] = tuple(pair)
    return _powers[which]


def latin_lower(raw: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with the capitals of Latin-1 lowered (those of ASCII are lowered when words are hashed)."""
    after = np.flatnonzero(raw[:-1] == 0xC3) + 1
    after = after[(raw[after] <= 0x9E) & (raw[after] != 0x97)]
    if len(after):
        raw = raw.copy()
        raw[after] += 0x20
    return raw


def words_of(text: str | np.ndarray, unicode_lower: bool = True, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte after) of each word. Without unicode_lower only A-Z are lowered, and the bytes are the text's own.

    With prefixes the hashes are rows: of the whole word, then of its first so many bytes (of the word if it is shorter).
    """
    raw = text if isinstance(text, np.ndarray) else np.frombuffer((text.lower() if unicode_lower else text).encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _IS_WORD[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    up, down = powers(0, len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
        whole = mixed((sums[ends] - sums[starts]) * down[starts])
        for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():  # sums modulo 2**64 tell some long words of two letters not apart
            whole[k] = xxhash.xxh3_64_intdigest(_LOWER[raw[starts[k] : ends[k]]].tobytes())
        if not prefixes:
            return whole, starts, ends
        parts = [mixed((sums[np.minimum(starts + k, ends)] - sums[starts]) * down[starts] + np.uint64(k) * np.uint64(0xD6E8FEB86659FD93)) for k in prefixes]
        return np.stack([whole, *parts]), starts, ends


def joined_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words' bytes, A-Z lowered, each with a space behind it; and where each begins, with the end of all."""
    edges = np.zeros(len(raw) + 1, np.int8)
    edges[starts] = 1
    edges[ends] -= 1
    inside = np.cumsum(edges, dtype=np.int8).astype(bool)
    body = np.full(len(raw) + 1, 32, np.uint8)
    body[:-1][inside[:-1]] = _LOWER[raw[inside[:-1]]]
    inside[ends] = True
    return body[inside].tobytes(), np.append(0, np.cumsum(ends - starts + 1))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the one shorter run if there are fewer words."""
    size = min(size, len(words))
    if not size:
        return words
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h = h * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
        return mixed(h)
