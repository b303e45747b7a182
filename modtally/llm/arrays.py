"""Words and rolling hashes of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

# Odd multipliers of the polynomial hash and of the final mixing.
BASE = 0x9E3779B97F4A7C15 | 2
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_ALL = (1 << 64) - 1
# Bytes that are hashed at a time.
AT_A_TIME = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


def byte_values() -> np.ndarray:
    """A 64-bit value for every byte."""
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(BASE))


def lowered() -> np.ndarray:
    """Byte table that lower-cases A-Z."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word ``[^\\x20\\x09-\\x0D]+`` in the bytes, and each row's offsets among the words."""
    n = len(raw)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    # Bytes wrap: what is below 9 lies far above 13.
    inside = (raw != 32) & (raw - np.uint8(9) > 4)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word's bytes (polynomial, then mixed with the length)."""
    out = np.zeros(len(starts), np.uint64)
    value = byte_values()
    up, down = powers(0)
    # A word's hash does not depend on where it stands: so many bytes at a time stay in a core's cache.
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + AT_A_TIME, side="right")))
        high = int(ends[last - 1])
        if high - low > len(up):
            up, down = powers(max(high - low, min(AT_A_TIME, len(raw))))
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(value[raw[low:high]] * up[: high - low], out=sums[1:])
        begin, end = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
        first = last
    return out


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Mixed hash of every ``width`` consecutive values (words' hashes, or bytes); row bounds are the caller's concern."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((byte_values()[values] if values.dtype == np.uint8 else mix(values)) * up, out=sums[1:])
    return mix((sums[width:] - sums[:n]) * down[:n])


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``start … start + length - 1`` for all pairs."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift
