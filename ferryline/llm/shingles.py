"""Word shingles of one text as 64-bit fingerprints, with numpy; a helper of the operators on near duplicates."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LETTERS = np.random.Generator(np.random.PCG64(20240601)).integers(1, 2**64, 256, dtype=np.uint64)
_BLANK = np.zeros(256, dtype=bool)
MOST_BITS = 1 << 16
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LETTERS[_BLANK] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def powers(length: int) -> np.ndarray:
    steps = np.full(length, _ODD, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def word_hashes(text: str) -> np.ndarray:
    """A fingerprint of every word ``[^\\x20\\x09-\\x0D]+``, with A-Z read as a-z."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    blank = _BLANK[raw]
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if raw.size and not blank[0]:
        starts = np.concatenate(([0], starts))
    if not starts.size:
        return np.empty(0, dtype=np.uint64)
    lengths = np.diff(np.append(starts, raw.size))
    place = np.arange(starts[0], raw.size) - np.repeat(starts, lengths)
    longest = int(lengths.max())
    power = powers(64) if longest <= 64 else powers(1 << (longest - 1).bit_length())
    return mix(np.add.reduceat(_LETTERS[raw[starts[0]:]] * power[place], starts - starts[0]))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct fingerprints of ``size`` neighbouring words; a shorter text is one shingle, none without words."""
    words = word_hashes(text or "")
    if not words.size:
        return words
    width = min(size, words.size)
    count = words.size - width + 1
    rolled = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        rolled = rolled * _ODD + words[k:k + count]
    return np.unique(mix(rolled))


def set_key(values: np.ndarray) -> int:
    """One signed 64-bit name for a set, the same for equal sets."""
    name = mix(np.add.reduce(mix(values ^ _ODD), keepdims=True) + np.uint64(values.size))
    return int(name.view(np.int64)[0])


def parity(values: np.ndarray, width: int = 0) -> np.ndarray:
    """A bitmap of a whole set, in 64-bit words: every fingerprint flips one bit, of ``width`` or of a power of two that is no less than the set.

    What two sets share cancels in the XOR, so its bits are never more than the fingerprints in which the sets differ.
    """
    width = width or min(MOST_BITS, max(64, 1 << (values.size - 1).bit_length()))
    odd = np.bincount((values & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def folded(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Parities, along the last axis, as they were with ``words`` words: halves are laid over one another."""
    while bitmaps.shape[-1] > words:
        half = bitmaps.shape[-1] // 2
        bitmaps = bitmaps[..., :half] ^ bitmaps[..., half:]
    return bitmaps


def odd_bits(bitmaps: np.ndarray) -> np.ndarray:
    """Set bits along the last axis; numpy counts those of the absolute value of signed words."""
    return np.bitwise_count(bitmaps.view(np.uint64)).sum(axis=-1, dtype=np.int64)
