"""Words of texts, and hashes of spans of bytes."""

from __future__ import annotations

import functools

import numpy as np

SLAB = 1 << 20  # bytes of text hashed at once
SEED = 0x5EED


def scrambled(values: np.ndarray) -> np.ndarray:
    """64-bit values mixed so that all bits depend on all (the finaliser of splitmix64)."""
    x = values.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(count: int, start: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return scrambled(np.arange(start, start + count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


BYTE_VALUES = seeds(256, SEED) | np.uint64(1)
BASE = 0xC2B2AE3D27D4EB4F

# Words are runs of bytes other than these six; A-Z count as a-z.
_AS_READ = np.arange(256, dtype=np.uint8)
_AS_READ[[9, 10, 11, 12, 13]] = 32
_AS_READ[65:91] += 32


@functools.lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of BASE and of its inverse modulo 2^64, 2^bits of them."""
    inverse = pow(BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(
            np.cumprod(np.concatenate([[np.uint64(1)], np.full((1 << bits) - 1, base, np.uint64)]), dtype=np.uint64)
            for base in (BASE, inverse)
        )


def hashed_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of `data`; equal bytes give equal hashes wherever they lie."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(starts, low + SLAB)))
        high = int(ends[last - 1])
        powers, inverses = _powers(max(10, int(high - low).bit_length()))
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTE_VALUES[data[low:high]] * powers[: high - low])])
            s, e = starts[first:last] - low, ends[first:last] - low
            out[first:last] = (sums[e] - sums[s]) * inverses[s] + (e - s).astype(np.uint64)
        first = last
    return scrambled(out)


def canonical_words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a text with single blanks between words and A-Z as a-z; starts and ends of its words in them."""
    data = _AS_READ[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)]
    blank = data == 32
    kept = ~blank
    kept[1:] |= ~blank[:-1]
    if len(kept):
        kept[0] = not blank[0]
    data = data[kept]
    gaps = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], gaps + 1]).astype(np.int64)
    ends = np.concatenate([gaps, [len(data)]]).astype(np.int64)
    if starts[-1] == len(data):
        starts, ends = starts[:-1], ends[:-1]
    return data, starts, ends
